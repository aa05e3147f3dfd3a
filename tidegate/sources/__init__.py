"""Readers, file inventories and control-plane inputs."""
