"""Plans: the star-schema builds, the listening-log builds, analyses and the whole run."""
