"""DataFrame operators: contracts, set checks, quarantine, silver, gold, reports, assurance."""
