"""tablespoon: order and customer analytics as plain PySpark DataFrame functions."""
