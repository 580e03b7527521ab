"""Multi-step jobs: the warehouse tables, loading, audit, reports and the pipelines over them."""
