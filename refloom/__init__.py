"""refloom: Spark-native operators for building reference tables from messy public data.

Subpackages: ``functions`` (Column expressions), ``operators`` (DataFrame operators),
``sources`` (archive / CSV / attribute-table / catalog readers), ``plans`` (bindings
to the driver tables, registered queries and their oracle SQL).
"""

__version__ = "0.1.0"
