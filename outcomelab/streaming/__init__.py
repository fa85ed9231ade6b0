"""Streaming operators.

The reference computes nothing on streams: it has no watermark, event-time
window, stateful operator or late-data rule.  Its only order-dependent
operators (running counts and sums per entity by date) are batch windows and
live in :mod:`outcomelab.operators.entity`.  This package is kept empty on
purpose rather than filled with operators the reference does not have.
"""
