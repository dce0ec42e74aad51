"""Readers and writers."""
from guestbook.sources.files import (
    export_word_scores,
    land_reviews,
    points_of_interest,
    read_poi_csv,
    read_review_csv,
)

__all__ = ["export_word_scores", "land_reviews", "points_of_interest", "read_poi_csv", "read_review_csv"]
