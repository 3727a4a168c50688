"""Plans: the pipeline DAG, its materialisation, the report runner and the registered queries."""
