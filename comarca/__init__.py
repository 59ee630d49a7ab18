"""comarca: Spark-native analytics for territory x period x category facts."""
