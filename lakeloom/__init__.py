"""Medallion-style batch ETL and star-schema operators on PySpark.

Every operator is a function DataFrame -> DataFrame (or Column -> Column) built
from Spark's own operators, so Catalyst and adaptive execution plan the work.
The most used entry points are re-exported here.
"""

from .functions.cleaning import (blank_to_null, clean_text_df, default_country, not_informed,  # noqa: F401
                                 pad_list, parse_date, parse_decimal, remove_accents,
                                 repair_double_encoding, strip, zero_pad)
from .functions.keys import hash_bucket, surrogate_key  # noqa: F401
from .operators.dedup import dedup_by_key, distinct_rows, latest_per_key  # noqa: F401
from .operators.layout import partition_advice, salt_advice  # noqa: F401
from .session import build_session  # noqa: F401
from .sources.archives import archive_lines  # noqa: F401
from .sources.csv import read_csv_with_quotes  # noqa: F401
from .sources.quarantine import store_rejects, stored_rejects  # noqa: F401
from .sources.sanitize import sanitize_csv  # noqa: F401

__version__ = "0.1.0"
