"""Column functions: text, URLs, salaries, experience, roles and skills."""
