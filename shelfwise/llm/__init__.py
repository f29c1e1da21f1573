"""Training-data operators (quality rules, token output, near-duplicate joins,
packing, substring removal, licence scans, fixity audits, toxicity, mixing and
top-k search) as Spark jobs. Nothing else in the library imports this package."""
