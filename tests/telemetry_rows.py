"""Where the small tables lie, and times of hand-made rows. Tests import from here, as each folder has a conftest of its own."""

from datetime import datetime, timedelta

SF = "/root/testdata/sf0.001"
DAY0 = datetime(2026, 9, 25)


def at(text: str) -> datetime:
    """``MM:SS[.ffffff]`` past the start of a day."""
    minutes, seconds = text.split(":")
    return DAY0 + timedelta(minutes=int(minutes), seconds=float(seconds))
