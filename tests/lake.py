"""Landed files for tests, written as plain NDJSON."""

from __future__ import annotations

import json
import uuid
from datetime import date, timedelta
from pathlib import Path


def write(root, source, day, records, *, ticker="AAPL", ingested="2026-08-17T10:00:00+00:00"):
    folder = Path(root) / source / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [
        json.dumps(
            {
                "record": record,
                "_ingested_at": ingested,
                "_request_metadata": {"endpoint": "/e", "ticker": ticker},
            }
        )
        for record in records
    ]
    path = folder / f"{uuid.uuid4()}.jsonl"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return path


def bar(day: date, close=10.0, volume=100):
    ms = (day - date(1970, 1, 1)).days * 86_400_000
    return {"t": ms, "o": close, "h": close, "l": close, "c": close, "v": volume, "vw": close, "n": 5}


def overview(ticker="AAPL", name="Apple Inc.", **more):
    return {
        "ticker": ticker,
        "name": name,
        "market": "stocks",
        "primary_exchange": "XNAS",
        "type": "CS",
        "active": True,
        "currency_name": "usd",
        "sic_code": "3571",
        "sic_description": "ELECTRONIC COMPUTERS",
        "market_cap": 3.0e12,
        "share_class_shares_outstanding": 15_000_000_000,
        "list_date": "1980-12-12",
        **more,
    }


def split(event="S1", ticker="AAPL", day="2020-08-31"):
    return {
        "id": event,
        "ticker": ticker,
        "execution_date": day,
        "split_from": 1,
        "split_to": 4,
        "adjustment_type": "forward_split",
        "historical_adjustment_factor": 0.25,
    }


def dividend(event="D1", ticker="AAPL", **more):
    return {
        "id": event,
        "ticker": ticker,
        "ex_dividend_date": "2026-08-10",
        "declaration_date": "2026-07-30",
        "record_date": "2026-08-11",
        "pay_date": "2026-08-14",
        "cash_amount": 0.26,
        "currency": "USD",
        "frequency": 4,
        "distribution_type": "recurring",
        "historical_adjustment_factor": 0.99,
        **more,
    }


def article(event="N1", insights=(("AAPL", "positive"),), published="2026-08-16T12:30:00Z"):
    return {
        "id": event,
        "title": f"Title {event}",
        "description": "text",
        "article_url": f"https://example.org/{event}",
        "published_utc": published,
        "publisher": {
            "name": "The Wire",
            "homepage_url": "https://wire.example.org",
            "logo_url": "logo",
            "favicon_url": "icon",
        },
        "insights": insights
        and [
            {"ticker": t, "sentiment": s, "sentiment_reasoning": "because"} for t, s in insights
        ],
    }


def fill(root, *, days=60):
    """A small but complete landing zone."""
    start = date(2026, 6, 1)
    series = [
        bar(start + timedelta(days=i), 100.0 + (i * 37) % 11, 1000 + (i * 71) % 13 + 9000 * (i == 40))
        for i in range(days)
    ]
    for ticker in ("AAPL", "MSFT"):
        write(root, "daily_bars", "2026-08-17", series, ticker=ticker)
        write(root, "ticker_overview", "2026-08-17", [overview(ticker)], ticker=ticker)
        write(root, "splits", "2026-08-17", [split(f"S-{ticker}", ticker)], ticker=ticker)
        write(root, "dividends", "2026-08-17", [dividend(f"D-{ticker}", ticker)], ticker=ticker)
    shared = article("N1", (("AAPL", "positive"), ("MSFT", "neutral"), ("QQQ", "neutral")))
    write(root, "news", "2026-08-17", [shared, article("N2")], ticker="AAPL")
    write(root, "news", "2026-08-17", [shared], ticker="MSFT")
