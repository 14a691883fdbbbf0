"""thermoflow: sensor-stream analytics written as PySpark DataFrame functions."""
