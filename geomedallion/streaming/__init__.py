"""Structured Streaming front end of the bronze layer (see ``landed``)."""

from geomedallion.streaming.landed import bronze_streams, landed_stream  # noqa: F401
