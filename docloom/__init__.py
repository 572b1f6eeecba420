"""docloom: Spark-first analytics for collections of structured documents."""
