"""The library's operators as named queries over the driver tables, with SQL to check them against."""
