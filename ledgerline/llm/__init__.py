"""Training-data operators. Nothing outside this subpackage imports it but the guard in ``__spark_entry__``."""
