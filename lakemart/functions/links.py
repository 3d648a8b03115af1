"""Video and post links."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Link formats of the ads platform.
SITE = "https://www.facebook.com"
WATCH = SITE + "/watch/?v="
VIDEO_PATH = r"/videos/([0-9]+)"
POST_ID = r"\A([0-9]+)_([0-9]+)\z"


def _watch_url(url: Column) -> Column:
    return F.concat(F.lit(WATCH), F.regexp_extract(url, VIDEO_PATH, 1))


def video_url(url: Column) -> Column:
    """Absolute link for a permalink, video path, video id or ``page_post`` id; null gives ``""``."""
    post = F.concat(
        F.lit(SITE + "/"), F.regexp_extract(url, POST_ID, 1),
        F.lit("/posts/"), F.regexp_extract(url, POST_ID, 2),
    )
    return (
        F.when(url.isNull() | (url == ""), F.lit(""))
        .when(url.startswith("http://") | url.startswith("https://"), url)
        .when(url.rlike(VIDEO_PATH), _watch_url(url))
        .when(url.rlike(r"\A[0-9]+\z"), F.concat(F.lit(WATCH), url))
        .when(url.rlike(POST_ID), post)
        .when(url.startswith("/"), F.concat(F.lit(SITE), url))
        .otherwise(url)
    )


def click_url(url: Column) -> Column:
    """Watch link when a video path occurs anywhere in the url, else the same as ``video_url``."""
    return F.when(url.rlike(VIDEO_PATH), _watch_url(url)).otherwise(video_url(url))
