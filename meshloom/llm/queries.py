"""The registered queries of this subpackage and the SQL that can express them."""

from __future__ import annotations

from .decontaminate import op1_decontaminate
from .divergence import op12_divergence, oracle as divergence_oracle
from .html import op3_html
from .langid import op7_langid
from .media import op4_media
from .mixing import op2_mixing, oracle as mixing_oracle
from .passages import op11_passages, oracle as passages_oracle
from .pii import op6_pii
from .secrets import op8_secrets
from .simhash import op5_simhash
from .substrings import op10_substrings
from .urls import op9_urls, oracle as urls_oracle

QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_mixing, op3_html, op4_media, op5_simhash, op6_pii, op7_langid, op8_secrets, op9_urls, op10_substrings, op11_passages, op12_divergence)}
ORACLE_SQL: dict[str, str] = {"op2_mixing": mixing_oracle(), "op9_urls": urls_oracle(), "op11_passages": passages_oracle(), "op12_divergence": divergence_oracle()}
