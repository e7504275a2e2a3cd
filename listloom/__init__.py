"""Contact-list segmentation, suppression, matching and export on Spark DataFrames."""

from listloom.model import Model
from listloom.plans.segment import Segment

__all__ = ["Model", "Segment"]
