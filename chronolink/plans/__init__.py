"""Building blocks that span stages (staging, numbering) and the end-to-end jobs."""
