"""tidemark: demand analytics over dated, segmented documents, native to PySpark."""
