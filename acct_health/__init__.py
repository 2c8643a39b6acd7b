"""Account-health analytics on order-line data, written as PySpark DataFrame operators.

Layout:
  sources/    readers, writers, the driver-table order-line view, calendar spine
  functions/  Column expressions (dates, categories, money, flags)
  operators/  reusable DataFrame operators (dedupe, global ntile, latest value,
              dominant value, data-quality profiles, referential integrity)
  plans/      composed jobs: cleaning stages, star schema, marts, KPIs
  streaming/  (empty: the reference is batch only)
"""
