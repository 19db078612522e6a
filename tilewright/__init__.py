"""tilewright: Spark-native place gazetteers as quadkey tiles."""
