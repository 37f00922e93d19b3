"""Training-data operators: search, mixing, near-duplicates, PII, toxicity,
quality, sharding, secrets, packing, collocations, fingerprints and token
alignment. Importing the package registers their
queries; nothing outside this package imports it but the driver entry."""

from . import alignment, collocations, embed_dedup, fingerprints, minhash, mixing, mtree, packing, pii, quality, secrets, sharding, toxicity  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
