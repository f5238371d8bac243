"""Host name of a URL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed pattern: scheme, credentials and "www." are optional and dropped; the host ends at the
# port, path, query or fragment.
HOST_PATTERN = (
    r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?"
    r"(?:[^\s:/?#@]+(?::[^\s/@]*)?@)?"
    r"(?:www\.)?"
    r"([A-Za-z0-9][A-Za-z0-9.-]*)"
)


def url_host(url: Column | str) -> Column:
    """The bare host (``https://user@www.example.com:90/x`` → ``example.com``), NULL if none."""
    return F.nullif(F.regexp_extract(F.col(url) if isinstance(url, str) else url, HOST_PATTERN, 1), F.lit(""))
