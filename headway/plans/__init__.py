"""Plans over whole tables and feeds: validation, and the registered queries."""
