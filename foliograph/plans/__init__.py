"""Query plans: whole tables in, whole tables out."""
