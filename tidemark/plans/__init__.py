"""Domain configuration, the star build, the measure catalogue and registered queries."""
