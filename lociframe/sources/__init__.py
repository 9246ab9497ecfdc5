"""Readers and writers of genome text formats. Every reader is a lazy scan over any number of files."""
