"""Stages composed of operators."""
