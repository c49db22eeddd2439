"""Model jobs on Spark MLlib. Labels, features and settings are this project's own choices."""
