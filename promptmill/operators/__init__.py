"""DataFrame operators: records, order, profiles, chat text, evaluation tables."""
