"""No operator of this library needs a stream: every input is a set of finished files.

The row-wise operators (hit thresholds, taxonomy classes against a static table, alias columns)
hold no state and accept a streaming DataFrame as they are.
"""
