"""CRM analytics on Spark: DataFrame functions, operators, reports and batch plans.

Every function takes and returns lazy DataFrames or Columns.  Nothing reads the clock:
"now" is always an explicit ``as_of`` argument.
"""

from tallyroute.session import cut_lineage, prepare, shared_dir

__all__ = ["cut_lineage", "prepare", "shared_dir"]
