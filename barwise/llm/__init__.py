"""Operators for building training corpora: packing, language ID, licence
scans, deduplication, token counts, decontamination and quality scores."""
