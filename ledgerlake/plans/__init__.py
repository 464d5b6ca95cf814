"""Query plans over the benchmark tables: stand-ins, registered queries, oracle SQL."""
