"""Marts, reports and job sequences composed from the operators."""
