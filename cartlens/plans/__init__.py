"""Plans: materialisation helpers, the batch chain and the registered queries."""
