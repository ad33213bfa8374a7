"""Runnable jobs composed from the operators; jobs own the writes."""
