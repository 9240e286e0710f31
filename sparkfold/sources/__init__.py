"""Readers and writers of learning tables and models."""
