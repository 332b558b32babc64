"""Rating-effects analytics on Spark.

A rating is modelled as a global mean plus an item effect, a user effect, one effect per
(user, tag) and a smoothed release-year curve.  Every effect is the shrunken mean of what the
effects before it left over.  All work is DataFrame expressions, joins and aggregates.
"""
