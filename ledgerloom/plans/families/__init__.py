"""Query registrations, one module per operator family."""
