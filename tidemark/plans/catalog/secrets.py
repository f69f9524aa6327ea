"""Catalogue: the secret-shaped text scan."""

from __future__ import annotations

from tidemark.operators import textscan
from tidemark.plans.catalog.common import query
from tidemark.sources import fixtures as fx


# ---- text scan ------------------------------------------------------------------------

def _findings(spark, d, **kw):
    docs = textscan.scan_text(fx.table(spark, d, "documents"), "doc_id", "text", "documents", **kw)
    pages = textscan.scan_text(fx.table(spark, d, "pages"), "page_id", "html", "pages", **kw)
    return docs.unionByName(pages)


@query
def leak_findings(spark, d):
    """L2 + L4: secret-shaped matches per text line, placeholders and allowed values dropped."""
    return _findings(spark, d)


@query
def leak_allowlist(spark, d):
    """L3: raw matches with the allow-list off, marked by whether the allow-list drops them."""
    return _findings(spark, d, allowed=(), placeholder="(?!)", mark_allowed=True).drop("hint")


@query
def leak_summary(spark, d):
    """Findings per rule and the verdict."""
    return textscan.scan_summary(_findings(spark, d))
