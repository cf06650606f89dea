"""Shared CLI plumbing for the spark-submit jobs."""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session(app: str, master: str | None):
    from trip_engine.session import build_session
    return build_session(master=master, app_name=app)


def parser(desc: str) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=desc)
    p.add_argument("--master", default=None, help="Spark master (spark-submit sets it)")
    return p
