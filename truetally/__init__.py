"""truetally: certified supply-chain metrics as Spark DataFrame plans.

Layers (each a set of plain DataFrame functions, optimised by Catalyst):

* ``sources``   -- reading inputs, fixed reference data, the driver-table adapter
* ``functions`` -- Column-expression helpers (calendar, units, zones, rules)
* ``operators`` -- reusable DataFrame operators (latest-per-key, prefix-sum
                   trailing windows, proportional allocation, row scope, ...)
* ``plans``     -- the conformed build, semantic model, scorecard, legacy
                   comparisons, gap waterfall, governance, entitlement, grading
* ``streaming`` -- intentionally empty: the modelled product has no streams
"""

from truetally.params import Params, DEFAULT_AS_OF  # noqa: F401
