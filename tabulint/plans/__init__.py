"""Whole runs composed from the operators, and ready rule sets."""
