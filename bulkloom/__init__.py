"""bulkloom: bulk-segregant and variant-table analytics on PySpark DataFrames."""
