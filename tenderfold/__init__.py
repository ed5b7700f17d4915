"""tenderfold: procurement publications folded into typed tables on Spark.

Layout
------
sources/    file scans: release JSON, notice/contract/expense XML, file order, rejects
functions/  column-level scalars (dates, codes, text cleaning, item picks)
operators/  set-based restatements of row loops: version log (upsert + history),
            aliases, identities, integrity checks, migration policies, backfill
plans/      analytic questions and the driver-table model used for oracle checks
streaming/  periodic files folded in as a Structured Streaming file source
"""

__all__ = ["session"]
