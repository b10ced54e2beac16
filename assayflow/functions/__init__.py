"""Part of assayflow; see the README."""
