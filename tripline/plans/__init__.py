"""Plans: compositions of operators (views, pipeline, ETL job, layout, ad hoc)."""
