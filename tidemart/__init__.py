"""Shop-event lakehouse on PySpark: raw messages -> bronze -> silver -> gold."""
