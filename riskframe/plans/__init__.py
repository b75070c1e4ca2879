"""End-to-end plans: crash feed, cleaning, modelling and monitoring."""
