"""Readers, writers, collectors and the benchmark, with files and answers made here."""

import gzip
import hashlib
import io
import json
import tomllib
import zipfile
from pathlib import Path
from urllib.error import HTTPError

import pytest

from veraz.operators import context, gold, quality
from veraz.plans import benchmark, catalogue
from veraz.sources import collect, files, tables, zipped
from veraz.streaming import ingest


class Response(io.BytesIO):
    def __init__(self, body, status=200, headers=None):
        super().__init__(body)
        self.status, self.headers = status, headers or {}


def test_csv_keeps_quoted_line_ends(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id_compra,objeto\n1,"a ""b""\nc"\n2,007\n')
    out = files.read_csv(spark, str(tmp_path / "x.csv"))
    assert [(r.id_compra, r.objeto) for r in out.collect()] == [("1", 'a "b"\nc'), ("2", "007")] and {t for _, t in out.dtypes} == {"string"}
    assert files.read_plain_csv(spark, str(tmp_path / "x.csv")).columns == ["id_compra", "objeto"]


def test_provenance_and_drift(spark, tmp_path):
    manifests = []
    for year, text in ((2025, "a,b\n1,2\n"), (2026, "a,c\n3,4\n")):
        p = tmp_path / f"x-itens-{year}.csv"
        p.write_text(text)
        manifests.append({"arquivo": str(p), "source_file_id": f"f{year}", "run_id": "r", "sistema_origem": "s"})
    out = files.read_with_provenance(spark, manifests, "itens")
    assert sorted((r.a, r.b, r.c, r._source_file_id) for r in out.collect()) == [("1", "2", None, "f2025"), ("3", None, "4", "f2026")]
    with pytest.raises(ValueError):
        files.read_with_provenance(spark, manifests, "outros")
    assert files.already_loaded(out, "f2025") and not files.already_loaded(out, "f1")


def test_zip_keeps_only_named_columns(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "Socios1.zip", "w") as z:
        z.writestr("a.csv", "12345678;1;Fulano de Tal;é\n".encode("latin-1"))
    out = zipped.read_zipped_csv(spark, str(tmp_path / "*.zip"), ["raiz", "tipo", "nome", "pais"], ["raiz", "pais"])
    assert [tuple(r) for r in out.collect()] == [("12345678", "é")]


def test_keys_and_payloads(spark, tmp_path):
    statement = json.dumps({"manifest": {"schema": {"columns": [{"name": "x"}, {"name": "numero_controle_pncp"}]}}, "result": {"data_array": [["1", "12345678000190-1-000007/2026"]] * 2}})
    assert [(r.cnpj, r.sequencial, r.ano) for r in files.statement_keys(spark, statement).collect()] == [("12345678000190", 7, 2026)]
    with pytest.raises(ValueError):
        files.statement_keys(spark, statement.replace("-1-", "-x-"))
    (tmp_path / "p.json").write_text(json.dumps({"data": [{"numeroControlePNCP": "b"}, {"numeroControlePNCP": "a"}, {}]}))
    assert [r.chave for r in files.page_keys(spark, str(tmp_path / "p.json")).collect()] == ["a", "b"]
    manifest = spark.createDataFrame([("p.json", hashlib.sha256((tmp_path / "p.json").read_bytes()).hexdigest()), ("q.json", "0")], "arquivo string, hash_payload string")
    assert {r.arquivo: r.integro for r in files.checked_payloads(spark, str(tmp_path), manifest).collect()} == {"p.json": True, "q.json": False}


def test_tables_change_once(spark, tmp_path):
    spark.sql(f"create database if not exists t1 location '{tmp_path}/t1'")
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    assert [tables.insert_new(spark, df, "t1.x", ["k"]) for _ in range(2)] == [2, 0]
    assert tables.add_missing_columns(spark, "t1.x", {"v": "int", "w": "string"}) == ["w"] and tables.add_missing_columns(spark, "t1.x", {"w": "string"}) == []
    with pytest.raises(ValueError):
        tables.overwrite(df, "t1.x; drop table y")
    old, new = spark.createDataFrame([("a", 5, "t"), ("b", 5, "t")], "k string, m int, h string"), spark.createDataFrame([("a", 5, "s"), ("b", 6, "s"), ("c", 1, "s")], "k string, m int, h string")
    assert {tuple(r) for r in tables.upsert_newer(old, new, "k", "m").collect()} == {("a", 5, "t"), ("b", 6, "s"), ("c", 1, "s")}
    assert {tuple(r) for r in tables.stored_conflicts(old, new, "k", "m", "h").collect()} == {("a", 5, "s")}
    assert {tuple(r) for r in tables.upsert(old, new.where("k = 'a'"), ["k"]).collect()} == {("a", 5, "s"), ("b", 5, "t")}
    assert {tuple(r) for r in tables.update_only(old, new.where("k = 'b'"), "k", "m").collect()} == {("a", 5, "t"), ("b", 6, "t")}
    for rows in (old, new):
        tables.replace(rows, str(tmp_path / "swap"))
    assert spark.read.parquet(str(tmp_path / "swap")).count() == 3 and [p.name for p in tmp_path.iterdir() if "swap" in p.name] == ["swap"]
    assert tables.content_rows(df, "d", "202601", "r").count() == 2
    spark.sql("drop database t1 cascade")


def test_pages_are_tried_again():
    waits, answers = [], [HTTPError("u", 503, "x", {}, io.BytesIO()), TimeoutError(), Response(b"{}")]

    def open_url(request, timeout):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    got = collect.publication_page("http://x", "20260101", 6, 1, open_url=open_url, sleep=waits.append, jitter=lambda: 0.5)
    assert (got.status, got.digest, len(got.attempts), waits) == (200, hashlib.sha256(b"{}").hexdigest(), 3, [1.5, 2.5]) and "tamanhoPagina=50" in got.url
    answers[:] = [HTTPError("u", 400, "x", {}, io.BytesIO())]
    with pytest.raises(collect.CollectionFailed):
        collect.get("http://x", open_url=open_url, sleep=waits.append)
    answers[:] = [Response(b"", 204)]
    assert collect.get("http://x", open_url=open_url).body is None
    answers[:] = [TimeoutError(), Response(b"{}")]
    assert collect.available("http://x", "d", 1, 2, 5, sleep=waits.append, open_url=open_url, attempts=1) and waits[-1] == 5


def test_downloads_appear_whole(tmp_path):
    target = tmp_path / "a.csv"
    packed = Response(gzip.compress(b"x,y\n1,2\n"), headers={"Content-Encoding": "gzip", "Last-Modified": "Tue, 15 Nov 1994 08:12:31 GMT"})
    m = json.loads(collect.download("http://x", target, "s", "d", "r", open_url=lambda *a, **k: packed).read_text())
    assert target.read_bytes() == b"x,y\n1,2\n" and m["hash_arquivo"] == collect.file_digest(target) and m["data_publicacao_arquivo"].startswith("Tue")
    collect.verify_file(target, m)
    with pytest.raises(ValueError):
        collect.download("http://x", tmp_path / "b", "s", "d", "r", open_url=lambda *a, **k: Response(b""))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.csv", "a.csv.manifest.json"]
    target.write_text('x,y\n1,"a\nb"\n2,c\n')
    collect.register_file(target, "u", "s", "d", "r")
    parts = collect.split_csv(target, tmp_path / "parts", max_bytes=5)
    assert [p.read_text() for p in parts] == ['x,y\n1,"a\nb"\n', "x,y\n2,c\n"] and json.loads(collect.manifest_path(parts[0]).read_text())["linhas_dados"] == 1
    with pytest.raises(ValueError):
        collect.verify_file(target, m)
    assert len(collect.annual_catalogue([2026, 2025, 2026])) == 12 and set(collect.context_catalogue("d", "a", "b")) == {"municipios_ibge", "ipca_indice", "ceis", "cnep"}


def test_batches_are_checked(tmp_path):
    (tmp_path / "p.json").write_bytes(b"{}")
    answer = {"endpoint": "e", "url_origem": "u", "data_inicio_consulta": "a", "data_fim_consulta": "b", "modalidade": 6, "pagina": 1, "coletado_em_utc": "t", "status_http": 200, "hash_payload": hashlib.sha256(b"{}").hexdigest(), "arquivo": "p.json", "tentativas": [{"numero": 1, "status_http": 200, "duracao_ms": 1, "erro": None}]}
    path = tmp_path / "m.json"
    put = lambda *answers: path.write_text(json.dumps({"run_id": "r", "criado_em_utc": "t", "respostas": list(answers)}))
    put(answer, answer | {"arquivo": None, "status_http": 204, "pagina": 2})
    batch = collect.read_batch(path)
    assert (len(batch.bronze), len(batch.requests), batch.runs[0]["status"]) == (1, 2, "SUCESSO")
    assert batch.bronze[0]["observacao_id"] == hashlib.sha256(b"r|e|a|b|6|1").hexdigest()
    for bad in ({"hash_payload": "0"}, {"arquivo": "../p.json"}):
        put(answer | bad)
        with pytest.raises(ValueError):
            collect.read_batch(path)


def test_links_are_measured(tmp_path):
    pages = {"1?pagina=1": b'{"data": [{}, {}], "totalPaginas": 2}', "1?pagina=2": b'{"data": [{}], "totalPaginas": 2}'}

    def open_url(request, timeout):
        key = request.full_url.rsplit("/", 1)[1].split("&")[0]
        if key in pages:
            return Response(pages[key])
        raise HTTPError(request.full_url, 404, "x", {}, io.BytesIO(b"{}"))

    controls = [collect.Control.of(f"12345678000190-1-{n}/2026") for n in (1, 2)]
    out = collect.measure_links(controls, tmp_path / "a", "r", "http://x", open_url=open_url)
    assert (out["contratacoes_com_vinculo"], out["contratos_encontrados"], out["respostas_404"], out["taxa_vinculo"]) == (1, 3, 1, 0.5)
    assert collect.measure_links([], tmp_path / "b", "r", "http://x")["taxa_vinculo"] == 0.0
    with pytest.raises(FileExistsError):
        collect.measure_links(controls, tmp_path / "a", "r", "http://x")
    with pytest.raises(ValueError):
        collect.Control.of("1-1-1/2026")
    doc = collect.stamp_evidence({"a": 1}, run="r")
    collect.check_evidence(doc, run="r")
    with pytest.raises(ValueError):
        collect.check_evidence(doc, run="q")


def test_streamed_ingest_loads_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in (1, 2):
        (tmp_path / f"in/{n}.csv").write_text(f"a,b\n{n},x\n")
        ingest.load_available(ingest.read_new_csv(spark, str(tmp_path / "in"), ["a", "b"]), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted((r.a, r._source_file_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("1", "1.csv"), ("2", "2.csv")]


def test_benchmark(spark):
    tables_ = catalogue.benchmark_tables(spark, "/root/testdata/sf0.001")
    assert set(benchmark.compare(spark, tables_, 1)) == set(benchmark.STRATEGIES)
    moved = benchmark.compare_traffic(spark, tables_)
    assert set(moved) == set(benchmark.STRATEGIES) and moved["merge"].shuffled > moved["broadcast"].shuffled > 0 and all(t.spilled == 0 < t.read for t in moved.values())
    assert benchmark.traffic(spark, lambda: None) == benchmark.Traffic(0, 0, 0)
    assert "BroadcastHashJoin" in benchmark.plan_text(benchmark.grouped(tables_, "broadcast")) and "SortMergeJoin" in benchmark.plan_text(benchmark.grouped(tables_, "merge"))
    with pytest.raises(ValueError):
        benchmark.grouped(tables_, "x")
    for label in ("", "-x", "X", "a" * 65, "a b", "a;b"):
        with pytest.raises(ValueError):
            benchmark.checked_label(label)
    assert benchmark.checked_label("a-1") == "a-1"
    with pytest.raises(ValueError):
        benchmark.fingerprint([(1,)])
    order = benchmark.protocol(3, ("a", "b"))
    assert order == [(0, "a"), (0, "b"), (1, "b"), (1, "a"), (2, "a"), (2, "b"), (3, "b"), (3, "a")]


def test_provenance_of_names_with_blanks_and_accents(spark, tmp_path):
    manifests = []
    for n, folder in enumerate(("um ano", "dois")):
        (tmp_path / folder).mkdir()
        p = tmp_path / folder / "x-itens-ação 2025.csv"
        p.write_text(f"a\n{n}\n")
        manifests.append({"arquivo": str(p), "source_file_id": f"f{n}", "run_id": "r"})
    out = files.read_with_provenance(spark, manifests, "itens")
    assert sorted((r.a, r._source_file_id, r._run_id, r._dataset_origem) for r in out.collect()) == [("0", "f0", "r", "itens"), ("1", "f1", "r", "itens")]
    with pytest.raises(ValueError, match="listed twice"):
        files.read_with_provenance(spark, [*manifests, manifests[0]], "itens")


def test_json_and_tables(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps([{"id": 1, "nome": "A", "microrregiao": {"mesorregiao": {"UF": {"sigla": "SP", "regiao": {"sigla": "SE"}}}}}], indent=1))
    assert [tuple(r) for r in context.municipalities(files.read_json(spark, str(tmp_path / "m.json"))).collect()] == [("1", "A", "SP", "SE")]
    index = spark.createDataFrame([("Mês (Código)", "Valor"), ("202601", "100.5"), ("202602", "...")], "D3C string, V string")
    assert [(r.competencia, float(r.numero_indice)) for r in context.price_index(index).collect()] == [("202601", 100.5)]
    spark.sql(f"create database if not exists t2 location '{tmp_path}/t2'")
    tables.ensure_schema(spark, "t2")
    tables.as_view(spark.range(3), "_three")
    tables.create_as(spark, "t2.n", "select id from _three")
    assert files.read_table(spark, "t2", "n").count() == 3 and tables.exists(spark, "t2.n") and not tables.exists(spark, "t2.x")
    with pytest.raises(ValueError):
        files.read_table(spark, "t2", "n; drop")
    assert tables.append_merged(spark.createDataFrame([(7, "x")], "id long, s string"), "t2.n") == ["s"]
    assert tables.append_merged(spark.range(1), "t2.n") == [] and tables.columns_of(spark, "t2.n") == ["id", "s"]
    assert sorted((r.id, r.s) for r in spark.table("t2.n").collect() if r.s or r.id == 2) == [(2, None), (7, "x")]
    detail = tables.physical(spark.table("t2.n")).first()
    assert detail.arquivos >= 2 and detail.bytes > 0 and detail.alterado_em
    with pytest.raises(ValueError, match="repeats a key"):
        tables.upsert(spark.range(1), spark.range(1).union(spark.range(1)), ["id"])
    spark.sql("drop database t2 cascade")


def test_a_failed_swap_keeps_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.replace(spark.range(2), path)
    real = tables._rename
    for part in (".new-", "/t"):
        monkeypatch.setattr(tables, "_rename", lambda spark, old, new, part=part: False if part in old[len(str(tmp_path)) :] and (part != "/t" or old == path) else real(spark, old, new))
        with pytest.raises(OSError):
            tables.replace(spark.range(5), path)
        assert spark.read.parquet(path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]


def _zipped(path, rows):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.csv", "\n".join(";".join(f'"{c}"' for c in r) for r in rows).encode("latin-1"))


def test_registries_keep_suppliers_only_and_no_persons(spark, tmp_path):
    suppliers = spark.createDataFrame([("12.345.678/0001-99",), ("123.456.789-01",), (None,), ("",)], "identificador_publico string")
    _zipped(tmp_path / "Empresas0.zip", [["12345678", "Ação SA", "2062", "49", "1000,00", "03"], ["99999999", "Outra", "1", "1", "1", "1", "x"]])
    (c,) = context.company_registry(spark, str(tmp_path / "Empresas*.zip"), suppliers).collect()
    assert (c.razao_social, c.ente_federativo_responsavel) == ("Ação SA", "")
    partner = ["12345678", "2", "FULANO DE TAL", "***123456**", "49", "20200101", "105", "***000000**", "BELTRANO", "05", "4"]
    for k in range(2):
        _zipped(tmp_path / f"Socios{k}.zip", [partner, ["99999999", *partner[1:]]])
    found = context.partner_registry(spark, str(tmp_path / "Socios*.zip"), suppliers)
    assert {tuple(r)[1:] for r in found.collect()} == {("12345678", "2", "49", "20200101", "105", "05", "4")} and len({r.registro_origem_id for r in found.collect()}) == 2
    assert not {"FULANO DE TAL", "BELTRANO", "***123456**"} & {v for r in found.collect() for v in r}
    line = [f"c{i}" for i in range(24)]
    line[1], line[3], line[4] = "99", "12.345.678/0001-99", "NOME"
    _zipped(tmp_path / "ceis.zip", [[f"campo{i}" for i in range(24)], line, [*line[:3], "1", *line[4:]]])
    _zipped(tmp_path / "cnep.zip", [[f"campo{i}" for i in range(25)], [*line[:10], "5,00", *line[10:]]])
    ceis, cnep = (context.sanction_registry(spark, str(tmp_path / f"{k.lower()}.zip"), k, suppliers).collect() for k in ("CEIS", "cnep"))
    want = ("99", "12345678000199", "c9", "c10", "c11", "c12", "c16", "c17", "c18", "c19", "c21")
    for name, fine, (r,) in (("CEIS", "", ceis), ("CNEP", "5,00", cnep)):
        assert (r.cadastro, r.valor_multa) == (name, fine) and tuple(r[c] for c in context.SANCTION_PLACES) == want and r.__fields__ == list(context.SANCTION_FIELDS)
    with pytest.raises(ValueError):
        context.sanction_registry(spark, "x", "outra", suppliers)


def test_catalogues_are_downloaded_once(tmp_path):
    asked = []

    def open_url(request, timeout):
        asked.append(request.full_url)
        return Response(b"x\n1\n")

    catalogue_ = {k: {"url": f"http://x/{k}", "arquivo": f"{k}.csv", "sistema": "s", "dataset": "d", "ano": "2026"} for k in "abc"}
    assert set(collect.download_all(catalogue_, tmp_path, "r", open_url=open_url).values()) == {"baixado"}
    assert set(collect.download_all(catalogue_, tmp_path, "r", open_url=open_url).values()) == {"existente"} and len(asked) == 3


def test_capabilities_and_attempts(tmp_path):
    def open_url(request, timeout):
        if "historico" in request.full_url:
            raise HTTPError(request.full_url, 404, "x", {}, io.BytesIO(b"{}"))
        return Response(b'{"data": [{}]}' if "termos" in request.full_url else b'{"numero": 1}')

    out = collect.measure_capabilities([collect.Control.of("12345678000190-1-1/2026")], tmp_path / "c", "r", "http://x", open_url=open_url)
    assert (out["contratos"], out["detalhe"], out["historico"], out["termos"]) == (1, 1, 0, 1)
    got = collect.get("http://x", open_url=lambda *a, **k: Response(b"{}"))
    assert [(a["numero"], a["status_http"]) for a in collect.attempts_as_rows(got)] == [(1, 200)]


def test_missing_events_and_counts(spark):
    """Contracts without events, and files without counts."""
    contracts = spark.createDataFrame([("1", "o", "f", "2026-01-01", "2026-12-31", 1.0, 1.0)], "contrato_id string, orgao_codigo string, fornecedor_id string, vigencia_inicio string, vigencia_fim string, valor_inicial double, valor_global double")
    events = spark.createDataFrame([], "evento_contrato_id string, contrato_id string, tipo_evento string, data_assinatura string, vigencia_fim string, variacao_valor double")
    (r,) = gold.contract_evolution(contracts, events).collect()
    assert (r.eventos_distintos, r.variacao_valor_acumulada, r.extensao_vigencia_dias, r.ultimo_evento_em) == (0, 0.0, 0, None)
    assert context.contract_coverage(contracts, events, events).first().cobertura_eventos == 0.0
    artifacts = spark.createDataFrame([("a", -1), ("b", -1)], "source_file_id string, total_linhas long")
    counts = quality.row_counts(spark.createDataFrame([("a",), ("a",)], "_source_file_id string"))
    assert sorted(map(tuple, quality.backfill_counts(artifacts, counts).collect())) == [("a", 2), ("b", -1)]


def test_shares_of_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0)], "k string, v double")
    assert sorted((str(r.k), r.s) for r in gold.with_share(df, "v", ("k",), "s").collect()) == [("None", 1.0), ("a", 0.25), ("a", 0.75)]


def test_workers_can_import_the_package():
    """The build names every package, so that it can be installed on a cluster."""
    root = Path(__file__).resolve().parents[1]
    spec = tomllib.loads((root / "pyproject.toml").read_text())
    assert spec["project"]["name"] == "veraz" and spec["tool"]["setuptools"]["packages"]["find"]["include"] == ["veraz*"]
    assert all((p.parent / "__init__.py").exists() for p in (root / "veraz").rglob("*.py"))


def test_evidence_files(tmp_path):
    path = tmp_path / "e" / "a.json"
    collect.write_evidence(path, {"linhas": 3}, origem="x", status="PUBLICAVEL")
    assert collect.read_evidence(path, origem="x", status="PUBLICAVEL")["linhas"] == 3
    with pytest.raises(ValueError):
        collect.read_evidence(path, origem="y", status="PUBLICAVEL")
