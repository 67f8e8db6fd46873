"""Readers, generators and writers of the tables the jobs use."""
