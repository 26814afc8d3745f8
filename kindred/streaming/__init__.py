"""Streams."""

from kindred.streaming.anchors import link_stream

__all__ = ["link_stream"]
