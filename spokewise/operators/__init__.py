"""Table operators: functions from DataFrame to DataFrame."""
