"""The queries of this subpackage and the SQL that some of them equal."""

from __future__ import annotations

from siteweave.llm.byte_pairs import op12_byte_pairs
from siteweave.llm.html_text import op2_html_text
from siteweave.llm.image_copies import op10_image_copies
from siteweave.llm.mixing import OP6_SQL, op6_source_mix
from siteweave.llm.near_duplicates import OP5_SQL, op5_near_duplicates
from siteweave.llm.neighbours import op1_nearest_neighbours
from siteweave.llm.pii import op9_pii_pseudonyms
from siteweave.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from siteweave.llm.secrets import op3_secret_scan
from siteweave.llm.sentence_pieces import op4_sentencepiece
from siteweave.llm.spelling import OP13_SQL, op13_spelling_variants
from siteweave.llm.token_files import op7_token_files
from siteweave.llm.toxicity import op8_toxicity

QUERIES = {f.__name__: f for f in (op1_nearest_neighbours, op2_html_text, op3_secret_scan, op4_sentencepiece, op5_near_duplicates, op6_source_mix, op7_token_files, op8_toxicity, op9_pii_pseudonyms, op10_image_copies, op11_prefix_trie, op12_byte_pairs, op13_spelling_variants)}
SQL = {"op5_near_duplicates": OP5_SQL, "op6_source_mix": OP6_SQL, "op11_prefix_trie": OP11_SQL, "op13_spelling_variants": OP13_SQL}
