"""Actor risk analytics on Spark: strict event decode, rolling rules, risk stores."""
