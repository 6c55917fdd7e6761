"""Where frames come from and go to: Kafka, queue pages, day archives."""
