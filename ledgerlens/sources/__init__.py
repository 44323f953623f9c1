from ledgerlens.sources.files import read_csv, stage_handoff, write_csv, write_parquet
from ledgerlens.sources.schema import LABELS, POPULATION, SYSTEM_ID, TRANSACTIONS, USERS

__all__ = ["read_csv", "write_csv", "write_parquet", "stage_handoff",
           "LABELS", "POPULATION", "USERS", "TRANSACTIONS", "SYSTEM_ID"]
