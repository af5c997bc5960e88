"""A columnar query and block-exchange engine on PySpark."""
