"""Readers. Every reader takes a declared schema; none infers one."""
