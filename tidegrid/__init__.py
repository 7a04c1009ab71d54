"""tidegrid: late, duplicated and out-of-order interval telemetry on Spark."""
