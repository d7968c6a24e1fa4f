"""orthoweave: a Spark-native engine for image-registration tables, with a training-data subpackage beside it."""
