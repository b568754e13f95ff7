"""Column expressions shared by the plans: calendar maths, counts and rates."""
