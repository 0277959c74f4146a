from tallyframe.sources import statement


def _parse(spark, lines):
    rows = [("f1", i, line) for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "file string, line_no long, line string")
    return statement.parse_statement(df).orderBy("record").collect()


def test_records_amounts_places_documents(spark):
    lines = [
        "BANCO EXTRACTO MENSUAL",           # before the first record: dropped
        "ENE 5 COMPRA POS 12345 ZIPAQUIRA III 1,234.50 10,000.00",
        "FEB 12 PAGO PSE 777",                # continuation below
        "  REDEBAN 20.00 9,980.00  ",
        "MAR 1 ABONO NOMINA INTERNET 2,000.00 11,980.00",
        "ABR 3 GRAVAMEN MOVS FINANCIEROS 8.00",  # one amount: balance only
        "MAY 9 CONSULTA SALDO ACH",               # no amounts
        "JUN 10 RETIRO 55 CALLE 53 1,000.00 2,000.00 3,000.00",  # three amounts
        "JUL 2 COMPRA 99 ZIPAQUIRA 5.00 100.00",
    ]
    r = _parse(spark, lines)
    assert len(r) == 7
    a = r[0]
    assert (a.date, a.transaction, a.document, a.place, a.debit, a.credit, a.balance) == \
        ("ENE 5", "COMPRA POS", "12345", "ZIPAQUIRA III", "1,234.50", "", "10,000.00")
    b = r[1]
    assert (b.transaction, b.document, b.place, b.debit, b.balance) == ("PAGO PSE", "777", "REDEBAN", "20.00", "9,980.00")
    c = r[2]
    assert (c.transaction, c.document, c.credit, c.debit) == ("ABONO NOMINA", "", "2,000.00", "")
    d = r[3]
    assert (d.transaction, d.document, d.debit, d.credit, d.balance) == ("GRAVAMEN MOVS FINANCIEROS", "", "", "", "8.00")
    e = r[4]
    assert (e.place, e.debit, e.credit, e.balance, e.document) == ("ACH", "", "", "", "SALDO")
    f = r[5]
    assert (f.place, f.debit, f.balance) == ("CALLE 53", "1,000.00", "3,000.00")
    assert r[6].place == "ZIPAQUIRA"


def test_csv_path_needs_six_commas_outside_amounts(spark):
    lines = ["AGO 1 PAGO 1,234.00 2,000.00",
             "SEP 2,TRANSFERENCIA,555,ACH,10.00,,90.00"]
    r = _parse(spark, lines)
    assert r[0].path == "text" and r[0].debit == "1,234.00"
    assert r[1].path == "csv"
    assert (r[1].date, r[1].transaction, r[1].document, r[1].place, r[1].debit, r[1].credit, r[1].balance) == \
        ("SEP 2", "TRANSFERENCIA", "555", "ACH", "10.00", "", "90.00")


def test_files_are_independent(spark):
    rows = [("f1", 0, "ENE 1 A 1 1.00 2.00"), ("f2", 0, "continuation only"), ("f2", 1, "FEB 2 B 2 3.00 4.00")]
    df = spark.createDataFrame(rows, "file string, line_no long, line string")
    out = statement.parse_statement(df).orderBy("file").collect()
    assert [(x.file, x.date) for x in out] == [("f1", "ENE 1"), ("f2", "FEB 2")]


def test_read_statement_files(spark, tmp_path):
    p = tmp_path / "s1.txt"
    p.write_text("HEADER\nENE 5 COMPRA 1 REDEBAN 10.00 20.00\nextra words\n", encoding="utf-8")
    lines = statement.read_statement_lines(spark, str(p))
    out = statement.parse_statement(lines).collect()
    assert len(out) == 1 and out[0].transaction == "COMPRA 1 extra" and out[0].document == "words"


def test_line_mode_matches_whole_file_across_splits(spark, tmp_path):
    p = tmp_path / "big.txt"
    rows = ["EXTRACTO"]
    for i in range(3000):
        rows.append(f"ENE {i % 28 + 1} COMPRA POS {i} REDEBAN")
        if i % 3 == 0:
            rows.append(f"continuacion {i} {i % 97}.00 {i % 89 + 100}.00")
    p.write_text("\n".join(rows) + "\n", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = statement.read_statement_lines(spark, str(p))
        assert lines.select("block").distinct().count() > 5
        a = {(r.record, r.text) for r in statement.stitch_lines(lines, block_col="block").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = statement.read_statement_lines(spark, str(p), whole_files=True)
    b = {(r.record, r.text) for r in statement.stitch_lines(whole).collect()}
    assert len(a) == 3000 and a == b
