"""Incremental jobs on Structured Streaming.

The studied pipeline skips subjects whose outputs already exist and processes
the rest.  Here that is a streaming file source with ``availableNow``: each
run picks up exactly the files not yet recorded in the checkpoint, processes
them in micro-batches and stops.
"""
