"""Readers, writers and the stream."""

import gzip

import pyarrow as pa
import pytest

from barsplice.sources import fastq, readers
from barsplice.streaming import canonical


def test_fastq(spark, tmp_path):
    one, two = tmp_path / "a.fastq.gz", tmp_path / "b.fastq.gz"
    with gzip.open(one, "wt") as f:
        f.write("@r1 x\nACGT\n+\nFFFF\n@r2\nGG\n+\nFF\n")
    with gzip.open(two, "wt") as f:
        f.write("@r1\nTT\n+\nFF\n")
    assert sorted(tuple(r) for r in readers.read_fastq(spark, [str(one)]).collect()) == [("r1 x", "ACGT", "FFFF"), ("r2", "GG", "FF")]
    assert [(r.h1, r.s2) for r in readers.read_fastq(spark, [str(one)], [str(two)]).collect()] == [("r1 x", "TT")]
    broken = tmp_path / "c.fastq"
    broken.write_text("@r1\nACGT\n+\n")
    with pytest.raises(Exception, match="Truncated FASTQ"):
        readers.read_fastq(spark, [str(broken)]).collect()
    readers.write_fastq(readers.read_fastq(spark, [str(one)]), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 8


def test_fastq_is_split(spark, tmp_path):
    """Small splits of one plain file: records across their borders, header-like qualities, pairs by position."""
    reads = [(f"r{i}", "ACGT" * (i % 7 + 1), "@" * (4 * (i % 7 + 1))) for i in range(500)]
    text = lambda suffix, n: "".join(f"@{h}/{suffix}\n{s}\n+\n{q}\n" for h, s, q in reads[:n])
    one, two = tmp_path / "a.fastq", tmp_path / "b.fq"
    one.write_text(text(1, 500))
    two.write_text(text(2, 300))
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = readers.read_fastq(spark, [str(one)])
        assert sorted(tuple(r) for r in got.collect()) == sorted((f"{h}/1", s, q) for h, s, q in reads)
        pairs = readers.read_fastq(spark, [str(one), str(two)], [str(two), str(one)]).collect()
        assert len(pairs) == 600 and all(r.h1[:-1] == r.h2[:-1] and r.s1 == r.s2 and r.h1 != r.h2 for r in pairs)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)


def test_fastq_splits_at_any_byte(tmp_path):
    """Every record once and in one split, for all borders; a truncated end is an error whatever split it lies in."""

    def read(path, size):
        out = []
        for part in fastq.splits([str(path)], size):
            with open(path, "rb") as file:
                begin = fastq.first_record(file, part.begin, part.size, part.path)
                file.seek(begin)
                for raw, ends in fastq.records(file, begin, part.end, part.path):
                    out += zip(*(c.to_pylist() for c in fastq._columns(raw, ends)), strict=True)
        return out

    reads = [("a b", "ACGT", "@+@+"), ("@c", "", ""), ("+", "G", "@"), ("d", "ACGTACGTAC", "@@@@@@@@@@"), ("e", "T", "+"), ("f", "CC", "@@")]
    path = tmp_path / "a.fastq"
    for end, last in (("\n", "\n"), ("\r\n", "\r\n"), ("\n", "")):
        text = end.join(f"@{h}{end}{s}{end}+{end}{q}" for h, s, q in reads) + last
        path.write_bytes(text.encode())
        for size in range(1, len(text) + 1):
            assert read(path, size) == reads, size
    whole = "".join(f"@{h}\n{s}\n+\n{q}\n" for h, s, q in reads)
    for cut in ("@g\nAC\n+\n", "@g\nAC\n", "@g\n"):
        path.write_text(whole + cut)
        for size in range(1, len(whole + cut) + 1):
            with pytest.raises(ValueError, match="Truncated FASTQ"):
                read(path, size)
    path.write_text("")
    assert read(path, 5) == []
    path.write_text("no reads\n" * 20)
    with pytest.raises(ValueError, match="no FASTQ record"):
        read(path, 50)


def test_fastq_plan(spark, tmp_path):
    """Single reads are not shuffled, pairs once a side; paths may be folders, patterns or repeated, compressed files may have members."""
    text = lambda a, b: "".join(f"@r{i}\nAC{'GT' * (i % 5)}\n+\nFF{'FF' * (i % 5)}\n" for i in range(a, b))
    (tmp_path / "a_1.fastq").write_text(text(0, 300))
    (tmp_path / "b_1.fq.gz").write_bytes(gzip.compress(text(300, 350).encode()) + gzip.compress(text(350, 400).encode()))
    one = readers.read_fastq(spark, [str(tmp_path / "a_1.fastq")], split_bytes=500)
    assert one.rdd.getNumPartitions() > 10 and "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    assert {r.header for r in readers.read_fastq(spark, [str(tmp_path)], split_bytes=700).collect()} == {f"r{i}" for i in range(400)}
    assert readers.read_fastq(spark, [str(tmp_path / "*_1.fastq")] * 2).count() == 600
    with pytest.raises(Exception, match="none"):
        readers.read_fastq(spark, [str(tmp_path / "none.fq")])
    pairs = readers.read_fastq(spark, [str(tmp_path)], [str(tmp_path)], split_bytes=700)
    assert pairs._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    rows = pairs.collect()
    assert len(rows) == 400 and all(r.h1 == r.h2 and r.s1 == r.s2 for r in rows)


def test_run_tables(spark, tmp_path):
    (tmp_path / "idx.tsv").write_text("exon_inclusion_a\t10\t5\t0\nexon_skipping_a\t10\t3\t0\n*\t0\t0\t9\n")
    assert {tuple(r) for r in readers.read_idxstats(spark, str(tmp_path / "idx.tsv")).collect()} == {("exon_inclusion_a", 5), ("exon_skipping_a", 3)}
    assert readers.missing_files(spark, [str(tmp_path / "idx.tsv"), str(tmp_path / "none")]) == [str(tmp_path / "none")]
    sheet = spark.createDataFrame([("a", "r1")], "sample string, replicate string")
    row = readers.run_metadata(spark, sheet, "splicing", "1", "run all").first()
    assert (row.pipeline, row.sample, row.command) == ("splicing", "a", "run all") and len(row.started) == 19
    readers.publish({"sheet": sheet}, str(tmp_path / "out"), ["sample"])
    assert spark.read.parquet(str(tmp_path / "out" / "sheet")).count() == 1
    rows = spark.createDataFrame([("q", 16, "v1", 9, 60, "4M", "*", 0, 0, "ACGT", "FFFF", {"NH": "1", "XS": "+"})], "qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string, tags map<string,string>")
    readers.write_sam(spark, rows, spark.createDataFrame([("v1", 30)], "name string, length int"), str(tmp_path / "sam"))
    assert spark.read.text(str(tmp_path / "sam.header")).first().value == "@SQ\tSN:v1\tLN:30"
    assert [tuple(r) for r in readers.read_sam(spark, str(tmp_path / "sam")).drop("tags").collect()] == [tuple(r) for r in rows.drop("tags").collect()]


def test_fasta_and_sam(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x one\nACGT\nacgt\n>y\nGG\n")
    assert {tuple(r) for r in readers.read_fasta(spark, str(tmp_path / "a.fa")).collect()} == {("x", "ACGTacgt"), ("y", "GG")}
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nq\t16\tc\t11\t60\t4M\t*\t0\t0\tACGT\tFFFF\tNH:i:1\tXS:A:+\n")
    row = readers.read_sam(spark, str(tmp_path / "a.sam")).first()
    assert (row.flag, row.pos, row.tags) == (16, 10, {"NH": "1", "XS": "+"})


def test_tables(spark, tmp_path):
    (tmp_path / "s.csv").write_text("sample,replicate,directory,read1,read2,reference,barcode,barcode_up,barcode_down,barcode_temp\na,r1,d,x,y,f,b,u,w,t\n")
    assert readers.read_sample_sheet(spark, str(tmp_path / "s.csv")).first().sample_id == "a_r1"
    (tmp_path / "bad.tsv").write_text("sample\treplicate\n")
    with pytest.raises(ValueError, match="lacks"):
        readers.read_sample_sheet(spark, str(tmp_path / "bad.tsv"))
    with pytest.raises(ValueError, match="neither"):
        readers.separator("abc")
    assert readers.separator("a\tb,c\td") == "\t"
    (tmp_path / "ids.csv").write_text("id,seq\ni1,ACGT\n")
    assert tuple(readers.read_delimited(spark, str(tmp_path / "ids.csv"), "id string, seq string").first()) == ("i1", "ACGT")
    readers.write_tsv(spark.createDataFrame([("a", None)], "x string, y string").coalesce(1), str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["x\ty", "a\tNA"]
    assert readers.check_names("a.fq.gz", "b.fa", "Barcode\tvariant\tvar_id\tcount") == []
    assert len(readers.check_names("a.txt", "b.txt", "x")) == 3


def test_log_statistics(spark):
    lines = spark.createDataFrame([("reads passed filter: 12",), ("Combined pairs: 7",), ("Uncombined pairs: 5",)], "value string")
    assert {r.name: r.value for r in readers.trim_statistics(lines).collect()} == {"reads passed filter": 12, "Combined pairs": 7, "Uncombined pairs": 5}
    lines = spark.createDataFrame([("  Total reads: 10",), ("Aligned 1 time: 6 (60%)",), ("Total reads: 1",)], "value string")
    assert {r.name: r.value for r in readers.aligner_statistics(lines).collect()} == {"Mapped": 6, "Total": 11}


def test_stream_equals_batch(spark, tmp_path):
    up, down, before, after = "GCAGTCCATGAC", "CTACGGTTAGCA", "TTGACCGATC", "GGATCATTCG"
    seq = before + "ACGTACCAGT" + after + up + "CCCCATGGGGGG" + down
    rows = [(f"r{i}", seq, "F" * len(seq)) for i in range(5)]
    spark.createDataFrame(rows[:2], "header string, seq string, qual string").write.parquet(str(tmp_path / "in"))
    spark.createDataFrame(rows[2:], "header string, seq string, qual string").write.mode("append").parquet(str(tmp_path / "in"))
    known = spark.createDataFrame([("CCCCATGGGGGG", "ACGTACCAGT", "v1", 1, 1)], "barcode string, variant string, var_id string, count long, line long")
    stream = spark.readStream.schema("header string, seq string, qual string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = canonical.start(stream, known, "canonical_stream", str(tmp_path / "ck"), before=before, after=after, up=up, down=down, template="NNNNATNNNNNN")
    query.processAllAvailable()
    query.stop()
    assert [(r.var_id, r.ref_type, r["count"]) for r in spark.table("canonical_stream").collect()] == [("v1", "exon_inclusion", 5)]


def test_stream_into_a_table(spark, tmp_path):
    """Batches count once, also when the last one is run again; folding changes nothing."""
    before, after, up, down = "TTGACCGATC", "GGATCATTCG", "GCAGTCCATGAC", "CTACGGTTAGCA"
    read = lambda exon, barcode: before + exon + after + up + barcode + down
    known = spark.createDataFrame([("CCCCATGGGGGG", "acACCAGTca", "v1", 1, 1)], "barcode string, variant string, var_id string, count long, line long")
    layout = {"before": before, "after": after, "up": up, "down": down, "template": "NNNNATNNNNNN"}
    path, ck = str(tmp_path / "counts"), str(tmp_path / "ck")
    assert canonical.current(spark, path).count() == 0 and canonical.compact(spark, path) == -1

    def add(*exons):
        rows = [(f"r{i}", read(e, "CCCCATGGGGGG"), "") for i, e in enumerate(exons)]
        spark.createDataFrame(rows, "header string, seq string, qual string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema("header string, seq string, qual string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        canonical.start_table(stream, known, path, ck, {"availableNow": True}, **layout).awaitTermination()
        return {(r.var_id, r.ref_type): r["count"] for r in canonical.current(spark, path).collect()}

    add("ACCAGT", "ACCAGT", "")
    add("ACCAGT")
    assert run() == {("v1", "exon_inclusion"): 3, ("v1", "exon_skipping"): 1}
    # The commit of the last batch is lost after its write: it is run again.
    last = max(p for p in (tmp_path / "ck" / "commits").iterdir() if p.name.isdigit())
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert run() == {("v1", "exon_inclusion"): 3, ("v1", "exon_skipping"): 1}
    assert canonical.compact(spark, path) == 0 and run() == {("v1", "exon_inclusion"): 3, ("v1", "exon_skipping"): 1}
    add("", "")
    assert run() == {("v1", "exon_inclusion"): 3, ("v1", "exon_skipping"): 3}
    assert canonical.compact(spark, path) == 1 and canonical.compact(spark, path) == 1
    # A part that was never finished does not count.
    (tmp_path / "counts" / "totals" / "through=2").mkdir()
    assert run() == {("v1", "exon_inclusion"): 3, ("v1", "exon_skipping"): 3}


def test_bam_round_trip(spark, tmp_path):
    """Records through BAM are those through SAM text, from whole files and from many splits of one file."""
    from barsplice.sources import bam

    lines = [
        f"r{i}\t{(0, 16, 4, 99)[i % 4]}\t{'*' if i % 4 == 2 else ('c1', 'chr_2')[i % 2]}\t{0 if i % 4 == 2 else 1 + i % 700}\t{i % 61}\t{('*', '5M', '3S10M25N7M', '2M1I3M2D4M')[i % 4]}\t{('*', '=', ('chr_2', 'c1')[i % 2])[i % 3] if i % 4 != 2 else '*'}\t{i % 50}\t{i % 7 - 3}"
        f"\t{'ACGTNACGTAC'[: i % 11] or '*'}\t{'IIFF#,:IIFF'[: i % 11] or '*'}\tNH:i:{i % 3}\tXA:Z:t{i % 13},x{'' if i % 5 else chr(9) + f'MD:Z:{i}'}"
        for i in range(5000)
    ]
    (tmp_path / "a.sam").write_text("@SQ\tSN:c1\tLN:1000\n" + "\n".join(lines) + "\n")
    want = readers.read_sam(spark, f"{tmp_path}/a.sam")
    contigs = spark.createDataFrame([("c1", 1000), ("chr_2", 2000)], "name string, length int")
    bam.write_bam(want.coalesce(1), contigs, f"{tmp_path}/one")
    bam.write_bam(want.repartition(3), contigs, f"{tmp_path}/one")  # replaces
    bam.write_bam(want.coalesce(1), contigs, f"{tmp_path}/single")
    rows = lambda df: sorted((tuple(r)[:-1], sorted(r.tags.items())) for r in df.collect())
    expected = rows(want)
    assert rows(bam.read_bam(spark, f"{tmp_path}/one")) == expected
    for size in (1000, 7000, 1 << 20):
        got = bam.read_bam(spark, f"{tmp_path}/single", size)
        assert rows(got) == expected
        assert size > 7000 or got.rdd.getNumPartitions() > 3
    assert rows(bam.read_bam(spark, f"{tmp_path}/single", 7000).where("flag = 16").limit(0)) == []


def test_bam_header_longer_than_splits():
    """Splits that lie inside of the header have no records; the header ends anywhere in a block or with it."""
    import io

    import pyarrow as pa

    from barsplice.sources import bam

    row = {"flag": 0, "rname": "c7", "pos": 4, "mapq": 9, "cigar": "4M", "rnext": "*", "pnext": 0, "tlen": 0, "seq": "ACGT", "qual": "IIII", "tags": []}
    header = bam.encode_header([(f"c{i}", 100_000) for i in range(30_000)])
    records = b"".join(bam.encode(row | {"qname": f"r{i}"}, {"c7": 7}) for i in range(3000))
    for blocks in ([header + records], [header, records]):
        packed = b"".join(bam.pack_block(raw[i : i + bam.BLOCK]) for raw in blocks for i in range(0, len(raw), bam.BLOCK)) + bam.pack_block(b"")
        file = pa.PythonFile(io.BytesIO(packed), "r")
        for split in (20_000, 1 << 20):
            found = [b for begin in range(0, len(packed), split) for b in bam._records(file, begin, min(len(packed), begin + split), len(packed))]
            assert [n for b in found for n in b.column("qname").to_pylist()] == [f"r{i}" for i in range(3000)]
            assert {r for b in found for r in b.column("rname").to_pylist()} == {"c7"}


def test_bam_small_splits_share_tasks(spark, tmp_path, monkeypatch):
    """As many splits as asked for, but not a task for each of thousands; what repeats in a batch is encoded once."""
    from barsplice.sources import bam

    names = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual", "tags"]
    rows = [(f"r{i}", 16 * (i % 2), f"c{i % 3}", i % 900, i % 61, f"{3 + i % 4}M", "=" if i % 5 else "c1", i, -i, "ACGTACG"[: 3 + i % 4], "FFGGHHI"[: 3 + i % 4] if i % 2 else None, [("NH", str(i % 4)), ("XV", f"v{i % 7}")] if i % 11 else None) for i in range(3000)]
    rows.append((None, None, None, None, None, None, None, None, None, None, None, [("XN", None)]))
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=bam._ARROW)
    number = {"c0": 0, "c1": 1, "c2": 2}
    one_by_one = [bam.encode(dict(zip(names, r, strict=True)), number) for r in rows]
    seen = []
    monkeypatch.setattr(bam, "_operations", lambda cigar, whole=bam._operations: seen.append(cigar) or whole(cigar))
    assert list(bam.encode_all(batch, number)) == one_by_one and list(bam.encode_all(batch.slice(1500), number)) == one_by_one[1500:]
    assert len(seen) <= 2 * 5
    raw = bam.encode_header([("c0", 1000), ("c1", 1000), ("c2", 1000)]) + b"".join(one_by_one)
    (tmp_path / "a.bam").write_bytes(b"".join(bam.pack_block(raw[i : i + 500]) for i in range(0, len(raw), 500)) + bam.pack_block(b""))
    reader = bam._Reader({"path": str(tmp_path / "a.bam"), "splitbytes": "200"})
    parts = reader.partitions()
    assert bam.TASKS <= len(parts) <= 2 * bam.TASKS and sum(len(p.ranges) for p in parts) == -(-(tmp_path / "a.bam").stat().st_size // 200)
    got = [n for p in parts for b in reader.read(p) for n in b.column("qname").to_pylist()]
    assert got == [r[0] or "*" for r in rows]


def test_bam_tag_kinds_and_long_records():
    """All kinds of tags, records longer than a block, and splits inside of them."""
    import io
    import struct

    import pyarrow as pa

    from barsplice.sources import bam

    tags = b"AAAx" + b"ABc" + struct.pack("<b", -5) + b"ACC\xff" + b"ADs" + struct.pack("<h", -300) + b"AES" + struct.pack("<H", 65000) + b"AFI" + struct.pack("<I", 1 << 31) + b"AGf" + struct.pack("<f", 0.5) + b"AHH1A\0" + b"AIBs" + struct.pack("<ihh", 2, -1, 7)
    base = {"flag": 0, "rname": "c1", "pos": 4, "mapq": 9, "cigar": "4M", "rnext": "*", "pnext": 0, "tlen": 0, "seq": "ACGT", "qual": "IIII", "tags": []}
    plain = bam.encode(base | {"qname": "r"}, {"c1": 0})
    tagged = struct.pack("<i", len(plain) - 4 + len(tags)) + plain[4:] + tags
    long = [bam.encode(base | {"qname": f"long{i}", "seq": "ACGT" * 40_000, "qual": "*", "cigar": "160000M"}, {"c1": 0}) for i in range(5)]
    raw = bam.encode_header([("c1", 200_000)]) + tagged + b"".join(long) + plain
    packed = b"".join(bam.pack_block(raw[i : i + bam.BLOCK]) for i in range(0, len(raw), bam.BLOCK)) + bam.pack_block(b"")
    file = pa.PythonFile(io.BytesIO(packed), "r")
    names = []
    for begin in range(0, len(packed), 400):
        for batch in bam._records(file, begin, min(len(packed), begin + 400), len(packed)):
            names += batch.column("qname").to_pylist()
            if begin == 0:
                assert dict(batch.column("tags")[0].as_py()) == {"AA": "x", "AB": "-5", "AC": "255", "AD": "-300", "AE": "65000", "AF": str(1 << 31), "AG": "0.5", "AH": "1A", "AI": "s,-1,7"}
    assert sorted(names) == ["long0", "long1", "long2", "long3", "long4", "r", "r"]
