"""Named queries over the star tables, their independent SQL answers, and the daily run."""
