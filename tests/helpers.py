"""Small helpers for hand-written JSONL fixtures."""

from __future__ import annotations

import json
import os


def write_lines(path: str, rows: list) -> str:
    """Write one JSONL file (rows are dicts, or raw text lines)."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        for r in rows:
            f.write((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n")
    return path


def details_row(appid, day, success=True, name="Game", raw=None, **extra):
    r = {"ingested_at": f"{day}T00:00:00+00:00", "ingestion_date": day,
         "source": "steam_store_appdetails", "appid": appid, "success": success,
         "type": "game" if success else None, "name": name if success else None,
         "raw": raw if success else None,
         "error_payload": None if success else {"success": False}}
    r.update(extra)
    return r


def details_raw(date="Mar 5, 2020", genres=None, categories=None, developers=("Dev",),
                publishers=("Dev",), is_free=False, coming_soon=False, **extra):
    r = {"steam_appid": 1, "type": "game", "name": "Game", "is_free": is_free,
         "developers": list(developers) if developers is not None else None,
         "publishers": list(publishers) if publishers is not None else None,
         "price_overview": {"currency": "USD", "initial": 1999, "final": 999},
         "categories": categories if categories is not None else [],
         "genres": genres if genres is not None else [],
         "release_date": {"coming_soon": coming_soon, "date": date}}
    r.update(extra)
    return r


def reviews_row(appid, day, success=True, total=10, good=7, **extra):
    r = {"ingested_at": f"{day}T00:00:00+00:00", "ingestion_date": day,
         "source": "steam_store_appreviews", "appid": appid, "success": success,
         "total_reviews": total if success else None,
         "good_reviews": good if success else None,
         "bad_reviews": (total - good) if success and total is not None else None,
         "review_score": 5 if success else None,
         "review_score_desc": "Mixed" if success else None,
         "num_reviews_returned": 3 if success else None,
         "raw": {} if success else None,
         "error_payload": None if success else {"success": 2}}
    r.update(extra)
    return r
