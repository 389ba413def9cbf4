"""DuckDB SQL of the operators' queries, where SQL can express them."""

from __future__ import annotations

from tripspark.llm import bbit_minhash, conversation_trie, secret_scan, source_mixing

SQL: dict[str, str] = {
    "op3_source_mixing": source_mixing.ORACLE,
    "op7_secret_scan": secret_scan.oracle_sql(),
    "op11_bbit_minhash": bbit_minhash.ORACLE,
    "op12_conversation_trie": conversation_trie.ORACLE,
}
