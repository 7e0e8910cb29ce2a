"""newsloom: a Spark-native engine for streams of web documents."""
