"""Column expressions; all native Catalyst expressions, no Python UDFs."""

from starmart.functions.dates import calendar_columns, sas_date
from starmart.functions.missing import is_missing
from starmart.functions.text import title_case

__all__ = ["calendar_columns", "sas_date", "is_missing", "title_case"]
