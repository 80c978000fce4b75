"""Registered queries by survey section; importing the package registers all of them."""
