"""Jobs: what runs when, and what it writes."""
