"""DataFrame-to-DataFrame operators: no session, no action, no collected data inside."""
