"""Parameters of the catalog queries, shared by the Spark and the SQL side."""

AS_OF = "2021-04-08"
VISIT_DAY = "2024-01-15"
COMPARE_DAY = "1998-06-15"
STATE_BEFORE = "1998-01-01"
TOP_START = "1997-01-01 00:00:00"
TOP_END = "1999-01-01 00:00:00"
TOP = 10
INTERVAL_DAYS = 60
WINDOW_DAYS = 10
SLIDE_DAYS = 5
WORD_ONE = "the"
WORD_TWO = "of"
WORD_TEXT = "by"
CHAIN_DAYS = 3000
NEVER_LATE = "10000 days"
STREAM_SALTS = 4
