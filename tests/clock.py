"""The tests' clock."""

AS_OF = "2024-01-30 12:30:00"
