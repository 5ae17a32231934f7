"""Inputs and registered queries."""
