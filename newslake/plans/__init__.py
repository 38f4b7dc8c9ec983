"""Query plans: marts, the registered query catalogue and its SQL oracle."""
