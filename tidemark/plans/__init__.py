"""Expression layer: tree rules (expr), compiler to DataFrame plans
(compile), the Spark-side node table for many requests (nodes), and batch
evaluation (batch)."""
