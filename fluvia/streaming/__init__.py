"""Delivery streams: dedupe, rate limit, debounce; incremental landing."""
