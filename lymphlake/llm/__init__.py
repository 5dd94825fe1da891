"""Ten operators of a training-data pipeline; nothing else imports this."""
