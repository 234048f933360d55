"""mixtape: playlist/interaction recommendation on Spark DataFrames.

Sub-packages:
  sources    - readers/writers (nested JSON slices, Parquet, models, test view)
  functions  - column-level helpers (text rows, URI lists, search predicates)
  operators  - DataFrame -> DataFrame operators (index, interactions, vectors,
               neighbours, factors, recommend, catalog, search)
  plans      - the registered queries and their DuckDB oracle SQL
  streaming  - micro-batch recommendation of arriving baskets
"""

from mixtape.session import get_session, ensure_checkpoint_dir, scratch_path

__all__ = ["get_session", "ensure_checkpoint_dir", "scratch_path"]
