"""Run parameters used by the registered queries (one ``as_of`` per run, D12)."""

import datetime as dt

# Papers in the stand-in tables run 60 days from 2024-01-01.
AS_OF = dt.date(2024, 2, 20)
# A single day that exists in the data, used by the day filters.
SAMPLE_DAY = dt.date(2024, 1, 15)
# A day on which stored summaries were made.
SUMMARY_DAY = dt.date(2024, 3, 2)
# ``--test`` mode of the range backfill.
TEST_DAYS_BACK = 7
# Stored rows are the papers ingested before this day; the feed holds every paper.
STORED_BEFORE = dt.date(2024, 2, 1)
# Search request over the stand-in codes (the library default is the AI list).
SEARCH_CODES = ("de", "src1", "src2", "src3")
SEARCH_START = dt.datetime(2024, 1, 10, 0, 0)
SEARCH_END = dt.datetime(2024, 2, 10, 23, 59)
# Fixed limits from the source application.
EXPORT_LIMIT = 5
QUEUE_LIMIT = 15
# The time of a run whose rows carry it; later than every stored summary.
RUN_TIME = dt.datetime(2024, 6, 1, 12, 30)
# One page of the search results.
PAGE_OFFSET = 40
PAGE_SIZE = 25
