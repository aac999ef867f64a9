"""Training-data operators on document tables (nothing else imports them)."""
