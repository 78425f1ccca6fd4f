"""The frame cleaning job (T15, D2, T17): one projection chain, one stage.

Every step is a native expression, so the whole job is a single
whole-stage-codegen span over the scan with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlake.functions import dates, text

NO_MEDIA = "No Media"

# --- fixed values: scraped record fields -> standard column names (P13) ----
STANDARD_NAMES = {
    "Channel": "channel",
    "Group ID": "group_id",
    "Message IDs": "message_ids",
    "Message": "message",
    "Text": "text",
    "Sender ID": "sender_id",
    "Date": "message_date",
    "Media Path": "media_path",
}
# --- end of fixed values ------------------------------------------------------


def standardize_columns(df: DataFrame, names: dict[str, str] = STANDARD_NAMES) -> DataFrame:
    """Rename the scraped record fields that are present (a projection)."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def clean_frame(df: DataFrame, as_of: str, message: str = "message", media: str = "media_path",
                date: str = "date", channel: str = "channel") -> DataFrame:
    """Clean scraped group records.

    * ``emojis``, ``links`` from the raw message;
    * URLs removed, then NULL message -> 'No Message';
    * NULL media list -> ``['No Media']``;
    * date parsed, unparsable or NULL -> ``as_of`` (a parameter, so reruns repeat);
    * message through the text cleaning chain (T14); channel stripped.

    The text cleaning chain runs after the 'No Message' fill, so a NULL message ends
    as 'No Mesage' (repeated letters collapse), as in the reference.
    """
    raw = F.col(message)
    media_default = F.array(F.lit(NO_MEDIA))
    if media in df.columns and not str(df.schema[media].dataType).startswith("Array"):
        media_default = F.lit(NO_MEDIA)
    steps = {
        "emojis": text.extract_emojis(raw),
        "links": text.extract_links(raw),
        message: text.clean_text(F.coalesce(text.remove_urls(raw), F.lit(text.NO_MESSAGE))),
    }
    if media in df.columns:
        steps[media] = F.coalesce(F.col(media), media_default)
    if date in df.columns:
        steps[date] = dates.coerce_timestamp(F.col(date), as_of)
    if channel in df.columns:
        steps[channel] = text.strip_ws(F.col(channel))
    return df.withColumns(steps)
