"""All queries of this subpackage; importing the modules registers them."""

from siltstone.llm import chat_format, fingerprint, jaccard_join, mixing, packing, quality, resample, shards, suffix_dedup, topk, url_filter, warc, whitening  # noqa: F401
from siltstone.llm.registry import ORACLES, QUERIES  # noqa: F401
