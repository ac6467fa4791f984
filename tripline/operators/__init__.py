"""DataFrame operators.  Each takes DataFrames (and a TripModel) and returns a
lazy DataFrame; none of them runs an action,
which proves a dimension's row bound before hinting a broadcast."""
