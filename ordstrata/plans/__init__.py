"""The tables of each layer, and the job that builds them all."""
