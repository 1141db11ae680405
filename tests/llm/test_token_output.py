import glob
import os
import struct
import zlib

import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from landfall.llm import token_output
from landfall.llm.queries import op7_token_output
from landfall.workspace import fresh_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


def digests(rows):
    """(doc_id, start, n_tokens, crc) in ascending doc_id order, null ids first."""
    tokenizer, before, out = Tokenizer.from_file(PATH), 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, before, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        before += len(ids)
    return out


def test_query_reads_back_what_the_tokenizer_says(spark, sf_rows):
    result = [tuple(r) for r in op7_token_output(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(result) == digests(sf_rows)


def test_edge_cases(spark, edge_docs, empty_docs):
    path = fresh_folder(spark, "tokens")
    token_output.write_tokens(edge_docs, path, PATH, partitions=3)
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    result = [tuple(r) for r in token_output.token_digests(token_output.read_tokens(spark, path), ["doc_id", "start", "n_tokens"]).collect()]
    assert sorted(result, key=str) == sorted(digests(rows), key=str)
    path = fresh_folder(spark, "tokens")
    token_output.write_tokens(empty_docs, path, PATH)
    assert token_output.read_tokens(spark, path).count() == 0


def test_files_can_be_read_in_part(spark, sf_docs):
    path = fresh_folder(spark, "tokens")
    token_output.write_tokens(sf_docs, path, PATH, partitions=2)
    files = sorted(glob.glob(os.path.join(path.removeprefix("file:"), "tokens", "*.parquet")))
    assert len(files) == 2
    group = pq.ParquetFile(files[0]).metadata.row_group(0)
    ids = next(group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema.startswith("ids"))
    assert any("DICTIONARY" in e or "DELTA" in e for e in ids.encodings)
    assert all(group.column(i).has_offset_index for i in range(group.num_columns))
    plan = token_output.read_tokens(spark, path, "doc_id", "start", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,local_start:bigint,n_tokens:bigint>" in plan
