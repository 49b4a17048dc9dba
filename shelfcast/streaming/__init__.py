"""Incremental (file-triggered) execution of the Silver transform."""
