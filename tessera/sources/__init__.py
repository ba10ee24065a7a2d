"""Readers and derived test inputs."""
