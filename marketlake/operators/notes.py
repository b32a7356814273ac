"""Research notes: batches of new notes, and the newest notes per user."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.text import snippet, ticker_of
from marketlake.operators.keys import assign_ids, first_per_key
from marketlake.operators.watchlists import ensure_users

# Notes shown, and characters shown of each.
NOTES_SHOWN = 10
NOTE_SNIPPET = 200


class Saved(NamedTuple):
    users: DataFrame
    notes: DataFrame
    new: DataFrame


def save_notes(users: DataFrame, notes: DataFrame, requests: DataFrame) -> Saved:
    """Store notes (request_id, email, ticker, note, requested_at); users are made as needed.

    `request_id` is unique; later requests get larger ids.
    """
    accounts = ensure_users(users, requests.select("email", "requested_at"))
    times = requests.select("request_id", "requested_at")
    numbered = assign_ids(times, ["requested_at", "request_id"], notes, "note_id").drop("requested_at")
    new = requests.join(numbered, "request_id").join(accounts.requested, "email").select(
        "note_id",
        "user_id",
        ticker_of("ticker").alias("ticker"),
        F.lit(None).cast("string").alias("title"),
        F.col("note").alias("content"),
        F.col("requested_at").alias("created_at"),
    )
    return Saved(accounts.users, notes.unionByName(new.select(notes.columns)), new)


def get_notes(
    users: DataFrame,
    notes: DataFrame,
    email: str | None = None,
    ticker: str | None = None,
    limit: int = NOTES_SHOWN,
) -> DataFrame:
    """The newest notes of one user, or of every user, with a snippet of each."""
    if ticker is not None:
        notes = notes.filter(F.col("ticker") == ticker_of(F.lit(ticker)))
    if email is not None:
        users = users.filter(F.col("email") == email)
    newest = [F.desc("created_at"), F.desc("note_id")]
    shown = notes.select(
        "note_id", "user_id", "ticker", snippet(F.col("content"), NOTE_SNIPPET).alias("snippet"), "created_at"
    )
    if email is not None:
        return shown.join(users.select("user_id", "email"), "user_id").orderBy(*newest).limit(limit)
    return first_per_key(shown, ["user_id"], newest, limit).join(users.select("user_id", "email"), "user_id")
