"""Operators for building, checking and reporting on an indicator data mart with Spark."""
