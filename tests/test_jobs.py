"""End-to-end medallion jobs on small hand-made landing folders (Latin-1, ';')."""

import datetime as dt
import io
import os
import zipfile

from pyspark.sql import functions as F

from lakeloom import schemas as S
from lakeloom.plans import incremental as inc
from lakeloom.plans import jobs
from lakeloom.sources.quarantine import stored_rejects


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(text.encode("iso-8859-1"))


def trade_landing(root):
    h = "CO_ANO;CO_MES;CO_NCM;CO_UNID;CO_PAIS;SG_UF_NCM;CO_VIA;CO_URF;QT_ESTAT;KG_LIQUIDO;VL_FOB"
    write(f"{root}/EXP_2024.csv", h + "\r\n2024;1;1012100;10;023;SP;1;1;3000000000;10;100\r\n"
          "2024;2;01012100;10;023;SP;1;1;5;10;50\r\n2024;2;99999999;10;999;RJ;1;1;1;1;1\r\n")
    write(f"{root}/IMP_2024.csv", h + ";VL_FRETE;VL_SEGURO\r\n2024;1;01012100;10;23;SP;1;1;2;3;40;1,5;0,25\r\n")
    write(f"{root}/NCM.csv", "CO_NCM;CO_UNID;CO_SH6;CO_PPE;CO_PPI;CO_FAT_AGREG;CO_CUCI_ITEM;CO_CGCE_N3;CO_SIIT;"
          "CO_ISIC_CLASSE;CO_EXP_SUBSET;NO_NCM_POR;NO_NCM_ESP;NO_NCM_ING\r\n"
          "01012100;10;10121;1;1;2;1;111;1;111;1;\"Cavalos; reprodutores\";x;y\r\n")
    write(f"{root}/NCM_SH.csv", "CO_SH6;NO_SH6_POR;CO_SH4;NO_SH4_POR;CO_SH2;NO_SH2_POR;NO_SEC_POR\r\n"
          "10121;Cavalos;101;Animais;1;Vivos;Seção I\r\n")
    write(f"{root}/NCM_ISIC.csv", "CO_ISIC_CLASSE;NO_ISIC_CLASSE;CO_ISIC_GRUPO;NO_ISIC_GRUPO;CO_ISIC_DIVISAO;"
          "NO_ISIC_DIVISAO;NO_ISIC_SECAO\r\n0111;Cultivo;011;Lavoura;01;Agro;A\r\n")
    write(f"{root}/NCM_CGCE.csv", "CO_CGCE_N3;NO_CGCE_N3;CO_CGCE_N2;NO_CGCE_N2;CO_CGCE_N1;NO_CGCE_N1\r\n"
          "111;Bens;11;Bens;1;Bens\r\n")
    write(f"{root}/NCM_FAT_AGREG.csv", "CO_FAT_AGREG;NO_FAT_AGREG;NO_FAT_AGREG_GP\r\n02;Básicos; \r\n")
    write(f"{root}/PAIS.csv", "CO_PAIS;CO_PAIS_ISON3;NO_PAIS;NO_PAIS_ESP;NO_PAIS_ING\r\n23;276;Alemanha;x;y\r\n")
    write(f"{root}/UF.csv", "CO_UF;SG_UF;NO_UF;NO_REGIAO\r\n35;SP;São Paulo;Sudeste\r\n")
    write(f"{root}/UF_MUN.csv", "CO_MUN_GEO;NO_MUN;NO_MUN_MIN;SG_UF\r\n3550308;São Paulo;sao paulo;SP\r\n")


def test_trade_jobs_end_to_end(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    trade_landing(landing)
    run1, run2 = dt.datetime(2024, 3, 1, 6), dt.datetime(2024, 3, 2, 6)
    st = {r["tabela"]: r for r in jobs.bronze_trade(spark, landing, lake, run1).collect()}
    assert st["exp"]["registros"] == 3 and st["imp"]["registros"] == 1 and st["ncm"]["status"] == "ok"
    assert all(r["status"] == "ok" for r in st.values()), st
    silver = {r["tabela"]: r for r in jobs.silver_trade(spark, lake, run1).collect()}
    assert all(r["status"] in ("ok", "skipped") for r in silver.values()), silver
    exp = spark.read.parquet(lake.silver("exp_tratado"))
    assert {r["QT_ESTAT"] for r in exp.collect()} >= {3000000000}          # Q9: no int overflow
    assert {r["CO_NCM"] for r in exp.collect()} == {"01012100", "99999999"}  # Q35: padded like the dim
    counts = {r["table_name"]: r["total_registros"] for r in jobs.gold_trade(spark, lake, run1).collect()}
    assert counts["fato_balanca_exp"] == 3 and counts["fato_balanca_imp"] == 1 and counts["dim_tempo"] == 2
    fact = spark.read.parquet(lake.gold("fato_balanca_exp"))
    missing = fact.filter(F.col("CO_NCM") == "99999999").first()
    assert missing["fk_produto"] is None and missing["fk_geografia"] is None
    assert fact.filter(F.col("fk_produto").isNotNull() & F.col("fk_geografia").isNotNull()).count() == 2
    imp = spark.read.parquet(lake.gold("fato_balanca_imp")).first()
    assert float(imp["valor_frete"]) == 1.5 and float(imp["valor_seguro"]) == 0.25
    prod = spark.read.parquet(lake.gold("dim_produto")).first()
    assert prod["NO_SH6_POR"] == "Cavalos" and prod["NO_ISIC_CLASSE"] == "Cultivo" and prod["NO_FAT_AGREG"] == "Básicos"
    view = spark.table("vw_balanca_comercial_consolidada")
    assert view.count() == 4
    # second run with no new files: nothing added anywhere
    jobs.bronze_trade(spark, landing, lake, run2)
    jobs.silver_trade(spark, lake, run2)
    counts2 = {r["table_name"]: r["total_registros"] for r in jobs.gold_trade(spark, lake, run2).collect()}
    assert counts2["fato_balanca_exp"] == 3 and counts2["fato_balanca_imp"] == 1
    dup = {r["dimension"]: r["duplicate_keys"] for r in spark.read.parquet(lake.gold("check_duplicate_keys")).collect()}
    assert dup == {"dim_tempo": 0, "dim_produto": 0, "dim_geografia": 0}


def zip_member(folder, archive, member, lines):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr(member, ("\r\n".join(lines) + "\r\n").encode("iso-8859-1"))
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, archive), "wb") as fh:
        fh.write(buf.getvalue())


def registry_landing(landing):
    zip_member(landing, "Empresas0.zip", "K.EMPRECSV", [
        '"12345678";"ACME; Açúcar LTDA";"2062";"49";"1000,00";"03";""',
        '"00000000";"SENTINEL";"2062";"49";"1,00";"01";""',
        '"1234567";"SHORT KEY SA";"2135";"50";"5,5";"05";""'])
    zip_member(landing, "Empresas1.zip", "K.EMPRECSV", ['"22222222";"Beta";"2062";"49";"abc";"01";""'])
    est = ['"12345678";"0001";"90";"1";"ACME";"02";"20200101";"0";"";"";"20200101";"4711302";"1,22,333";'
           '"RUA";"X";"1";"";"C";"01000000";"sp";"7107";"11";"1";"";"";"";"";"";"";""',
           '"12345678";"0002";"70";"2";"";"08";"20230229";"1";"";"";"00000000";"4711302";"";'
           '"RUA";"Y";"2";"";"C";"01000000";"SP";"7107";"11";"2";"";"";"";"";"";"";""',
           '"22222222";"0001";"11";"1";"BETA";"02";"20240229";"0";"";"";"20240229";"0111301";"4711302";'
           '"RUA";"Z";"3";"";"C";"20000000";"RJ";"6001";"21";"3";"";"";"";"";"";"";""']
    zip_member(landing, "Estabelecimentos0.zip", "K.ESTABELE", est)
    zip_member(landing, "Socios0.zip", "K.SOCIOCSV", [
        '"12345678";"2";"JOÃO DA SILVA";"***123456**";"49";"20200101";"";"";"";"00";"4"'])
    zip_member(landing, "Naturezas.zip", "K.NATJUCSV", ['"2062";"Sociedade Empresária Limitada"'])
    zip_member(landing, "Qualificacoes.zip", "K.QUALSCSV", ['"49";"Sócio-Administrador"'])
    zip_member(landing, "Paises.zip", "K.PAISCSV", ['"105";"BRASIL"'])


def test_registry_jobs_end_to_end(spark, tmp_path):
    landing, lake = str(tmp_path / "zips"), jobs.Lake(str(tmp_path / "lake"))
    registry_landing(landing)
    run1 = dt.datetime(2024, 3, 1, 6)
    st = {r["tabela"]: r for r in jobs.bronze_registry(spark, landing, lake, run1).collect()}
    assert st["empresas"]["registros"] == 4 and st["estabelecimentos"]["registros"] == 3
    silver = {r["tabela"]: r for r in jobs.silver_registry(spark, lake, run1).collect()}
    assert silver["empresas_tratado"]["status"] == "ok", silver
    comp = {r["CNPJ_BASICO"]: r for r in spark.read.parquet(lake.silver("empresas_tratado")).collect()}
    assert set(comp) == {"12345678", "01234567", "22222222"}                  # sentinel dropped, key padded
    assert comp["12345678"]["RAZAO_SOCIAL_NOME_EMPRESARIAL"] == "ACME ACUCAR LTDA"
    assert float(comp["12345678"]["CAPITAL_SOCIAL_DA_EMPRESA"]) == 1000.0
    assert comp["22222222"]["CAPITAL_SOCIAL_DA_EMPRESA"] is None
    e = {r["CNPJ_ORDEM"]: r for r in spark.read.parquet(lake.silver("estabelecimentos_tratado"))
         .filter(F.col("CNPJ_BASICO") == "12345678").collect()}
    assert e["0001"]["IS_MATRIZ"] and e["0001"]["IS_ATIVA"] and e["0001"]["QT_FILIAIS"] == 1
    assert e["0001"]["CNAE_FISCAL_SECUNDARIA"] == "0000001,0000022,0000333"
    assert e["0002"]["CNAE_FISCAL_SECUNDARIA"] is None and e["0002"]["DATA_SITUACAO_CADASTRAL"] is None
    assert e["0001"]["UF"] == "SP"
    counts = {r["table_name"]: r["total_registros"] for r in jobs.gold_registry(spark, lake, run1).collect()}
    assert counts["dim_empresa"] == 3 and counts["dim_estabelecimento"] == 3 and counts["fato_estabelecimento"] == 3
    fact = {r["CO_CNPJ_BASICO"]: r for r in spark.read.parquet(lake.gold("fato_estabelecimento")).collect()}
    assert fact["12345678"]["SG_UF_RESPONSAVEL"] == "SP"                     # head office (0001) chosen
    assert fact["01234567"]["fk_estabelecimento"] is None
    dc = {r["CO_CNPJ_BASICO"]: r for r in spark.read.parquet(lake.gold("dim_empresa")).collect()}
    assert dc["12345678"]["NO_NATUREZA_JURIDICA"] == "SOCIEDADE EMPRESARIA LIMITADA"
    p = spark.read.parquet(lake.gold("dim_socios_perfil")).first()
    assert p["NO_QUALIFICACAO"] == "SOCIOADMINISTRADOR" and p["CO_PAIS"] == "105" and p["NO_PAIS"] == "BRASIL"
    assert spark.table("vw_empresa_completa").count() == 4          # 3 establishments + 1 company without any
    regions = {r["SG_UF"]: r["total_empresas"] for r in spark.table("vw_empresas_por_regiao").collect()}
    assert regions["SP"] == 1 and regions["RJ"] == 1
    assert spark.table("vw_empresa_socios_detalhado").first()["NO_RAZAO_SOCIAL"] == "ACME ACUCAR LTDA"
    # rerun: the manifest keys on (archive, member), nothing is loaded twice
    st2 = {r["tabela"]: r["registros"] for r in jobs.bronze_registry(spark, landing, lake,
                                                                       dt.datetime(2024, 3, 2)).collect()}
    assert st2["empresas"] == 0


def test_cli_trade(spark, tmp_path):
    from lakeloom import cli
    landing = str(tmp_path / "landing")
    trade_landing(landing)
    rc = cli.main(["trade", "--landing", landing, "--lake", str(tmp_path / "lake"),
                   "--run-ts", "2024-03-01T06:00:00"])
    assert rc == 0
    assert spark.read.parquet(str(tmp_path / "lake" / "gold" / "fato_balanca_exp")).count() == 3


def test_trade_rerun_after_partial_batch_is_exact(spark, tmp_path):
    """A bronze batch written without its manifest row (a crash) is invisible downstream
    and reloaded by the next run; gold is the same as after one clean run."""
    import shutil
    from lakeloom.plans import incremental as inc
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    trade_landing(landing)
    run1 = dt.datetime(2024, 3, 1, 6)
    jobs.bronze_trade(spark, landing, lake, run1)
    # simulate a crash after the data write of run1: drop the manifest (the commit log)
    shutil.rmtree(lake.manifest)
    assert inc.committed(spark, spark.read.parquet(lake.bronze("exp")), lake.manifest, "EXP").count() == 0
    run2 = dt.datetime(2024, 3, 2, 6)
    jobs.bronze_trade(spark, landing, lake, run2)
    assert spark.read.parquet(lake.bronze("exp")).count() == 6          # orphan batch still on disk
    jobs.silver_trade(spark, lake, run2)
    jobs.gold_trade(spark, lake, run2)
    jobs.gold_trade(spark, lake, run2)                                   # a repeated gold step
    assert spark.read.parquet(lake.silver("exp_tratado")).count() == 3
    assert spark.read.parquet(lake.gold("fato_balanca_exp")).count() == 3


def test_registry_rerun_after_partial_batch_is_exact(spark, tmp_path):
    import shutil
    landing, lake = str(tmp_path / "zips"), jobs.Lake(str(tmp_path / "lake"))
    registry_landing(landing)
    jobs.bronze_registry(spark, landing, lake, dt.datetime(2024, 3, 1, 6))
    shutil.rmtree(lake.manifest)                     # crash before the commit log was written
    run2 = dt.datetime(2024, 3, 2, 6)
    jobs.bronze_registry(spark, landing, lake, run2)
    jobs.silver_registry(spark, lake, run2)
    jobs.silver_registry(spark, lake, run2)          # a repeated silver step
    assert spark.read.parquet(lake.silver("empresas_tratado")).count() == 3
    assert spark.read.parquet(lake.silver("estabelecimentos_tratado")).count() == 3
    counts = {r["table_name"]: r["total_registros"] for r in jobs.gold_registry(spark, lake, run2).collect()}
    assert counts["dim_empresa"] == 3 and counts["fato_estabelecimento"] == 3


def test_trade_silver_optional_dedup(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    h = "CO_ANO;CO_MES;CO_NCM;CO_UNID;CO_PAIS;SG_UF_NCM;CO_VIA;CO_URF;QT_ESTAT;KG_LIQUIDO;VL_FOB"
    write(f"{landing}/EXP_2023.csv", h + "\r\n2023;5;1;1;1;SP;1;1;1;1;1\r\n2023;5;1;1;1;SP;1;1;1;1;1\r\n"
          "2023;6;1;1;1;SP;1;1;1;1;1\r\n")
    run = dt.datetime(2024, 3, 1, 6)
    jobs.bronze_trade(spark, landing, lake, run)
    jobs.silver_trade(spark, lake, run, dedup=True)
    assert spark.read.parquet(lake.silver("exp_tratado")).count() == 2


def test_cli_registry(spark, tmp_path):
    from lakeloom import cli
    landing = str(tmp_path / "zips")
    registry_landing(landing)
    rc = cli.main(["registry", "--landing", landing, "--lake", str(tmp_path / "lake"),
                   "--run-ts", "2024-03-01T06:00:00"])
    assert rc == 0
    assert spark.read.parquet(str(tmp_path / "lake" / "gold" / "fato_estabelecimento")).count() == 3


def test_gold_trade_reports_missing_inputs(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path / "lake"))
    out = {r["tabela"]: r["status"] for r in jobs.gold_trade(spark, lake, dt.datetime(2024, 3, 1)).collect()}
    assert out["exp_tratado"] == "skipped" and len(out) == 10


EXP_HEADER = "CO_ANO;CO_MES;CO_NCM;CO_UNID;CO_PAIS;SG_UF_NCM;CO_VIA;CO_URF;QT_ESTAT;KG_LIQUIDO;VL_FOB"


def drop_manifest_rows(spark, lake, tipo):
    """As after a crash between the data and the manifest of one table."""
    import shutil
    rest = spark.read.schema(inc.MANIFEST_SCHEMA).parquet(lake.manifest).where(F.col("tipo_operacao") != tipo).collect()
    shutil.rmtree(lake.manifest)
    spark.createDataFrame(rest, inc.MANIFEST_SCHEMA).write.parquet(lake.manifest)


def test_rejects_reach_the_quarantine(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    write(f"{landing}/EXP_2024.csv", EXP_HEADER + "\r\n2024;1;1;10;023;SP;1;1;3;10;100\r\nshort;line\r\n"
          "2024;1;1;10;023;SP;1;1;3;10;100;too;long\r\n")
    write(f"{landing}/UF.csv", "CO_UF;SG_UF\r\n35;SP\r\nbad\r\n")
    write(f"{landing}/EXP_2023.csv", EXP_HEADER + "\r\nonly;bad\r\n")
    st = {r["tabela"]: r for r in jobs.bronze_trade(spark, landing, lake, dt.datetime(2024, 3, 1)).collect()}
    assert (st["exp"]["registros"], st["exp"]["rejeitados"]) == (1, 3)
    assert (st["uf"]["registros"], st["uf"]["rejeitados"]) == (1, 1)
    bad = stored_rejects(spark, lake.quarantine("exp")).collect()
    assert sorted(r["linha"] for r in bad) == ["2024;1;1;10;023;SP;1;1;3;10;100;too;long", "only;bad", "short;line"]
    live = {r["nome_arquivo"]: r for r in inc.live_files(inc.read_manifest(spark, lake.manifest, "EXP")).collect()}
    assert live["EXP_2023.csv"]["num_registros"] == 0 and live["EXP_2023.csv"]["num_rejeitados"] == 1
    again = {r["tabela"]: r for r in jobs.bronze_trade(spark, landing, lake, dt.datetime(2024, 3, 2)).collect()}
    assert again["exp"]["registros"] == 0 and again["exp"]["rejeitados"] == 0   # the file without a good row is known


def test_only_bad_rows_in_the_first_file(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    write(f"{landing}/EXP_2024.csv", EXP_HEADER + "\r\nonly;bad\r\n")
    st = {r["tabela"]: r for r in jobs.bronze_trade(spark, landing, lake, dt.datetime(2024, 3, 1)).collect()}
    assert st["exp"]["status"] == "ok" and st["exp"]["rejeitados"] == 1


def test_one_tables_lost_manifest_rows(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    trade_landing(landing)
    run1, run2 = dt.datetime(2024, 3, 1, 6), dt.datetime(2024, 3, 2, 6)
    jobs.bronze_trade(spark, landing, lake, run1)
    drop_manifest_rows(spark, lake, "IMP")
    jobs.bronze_trade(spark, landing, lake, run2)
    jobs.silver_trade(spark, lake, run2)
    assert spark.read.parquet(lake.silver("imp_tratado")).count() == 1
    assert spark.read.parquet(lake.silver("exp_tratado")).count() == 3


def test_full_refresh_counts_once_and_survives_a_crash(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    trade_landing(landing)
    days = [dt.datetime(2024, 3, d, 6) for d in range(1, 6)]
    jobs.bronze_trade(spark, landing, lake, days[0])
    for d in days[1:3]:
        jobs.bronze_trade(spark, landing, lake, d, mode="full")
    manifest = inc.read_manifest(spark, lake.manifest)
    assert {r["tipo_operacao"]: r["registros"] for r in inc.run_summary(manifest).collect()}["EXP"] == 3
    seen = lambda: inc.committed(spark, spark.read.parquet(lake.bronze("exp")), lake.manifest, "EXP").count()
    assert seen() == 3
    before = manifest.collect()
    import shutil
    backup = str(tmp_path / "backup")
    shutil.copytree(lake.bronze("exp"), backup)
    jobs.bronze_trade(spark, landing, lake, days[3], mode="full")       # dies before its manifest rows ...
    shutil.copytree(backup, lake.bronze("exp"), dirs_exist_ok=True)     # ... so the old batch is still there
    shutil.rmtree(lake.manifest)
    spark.createDataFrame(before, inc.MANIFEST_SCHEMA).write.parquet(lake.manifest)
    assert seen() == 3
    jobs.bronze_trade(spark, landing, lake, days[4])
    jobs.silver_trade(spark, lake, days[4])
    assert spark.read.parquet(lake.silver("exp_tratado")).count() == 3


def test_republished_file_replaces_its_rows(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    row = "2024;1;1;10;023;SP;1;1;3;10;100\r\n"
    write(f"{landing}/EXP_2024.csv", EXP_HEADER + "\r\n" + row)
    jobs.bronze_trade(spark, landing, lake, dt.datetime(2024, 3, 1), key="version")
    write(f"{landing}/EXP_2024.csv", EXP_HEADER + "\r\n" + row + row.replace("SP", "RJ"))
    jobs.bronze_trade(spark, landing, lake, dt.datetime(2024, 3, 2), key="version")
    jobs.silver_trade(spark, lake, dt.datetime(2024, 3, 2))
    assert sorted(r["SG_UF_NCM"] for r in spark.read.parquet(lake.silver("exp_tratado")).collect()) == ["RJ", "SP"]


def test_rebuild_drops_partitions_that_no_longer_occur(spark, tmp_path):
    log, target = str(tmp_path / "log"), str(tmp_path / "t")
    for day, salts in ((1, 4), (2, 1)):
        src = spark.range(8).select("id", F.lit(dt.datetime(2024, 3, day)).alias("ingestion_dt"))
        inc.process_incremental(spark, src, log, "t", lambda d, n=salts: d.withColumn("salt", F.col("id") % n), target,
                                dt.datetime(2024, 3, day), ["salt"], "rebuild")
    assert spark.read.parquet(target).count() == 8


def test_append_step_repeated_before_its_watermark(spark, tmp_path):
    import shutil
    log, target = str(tmp_path / "log"), str(tmp_path / "t")
    src = spark.range(5).select("id", F.lit(dt.datetime(2024, 3, 1)).alias("ingestion_dt"))
    step = lambda s, d: inc.process_incremental(spark, s, log, "t", lambda x: x, target, dt.datetime(2024, 3, d))
    step(src, 1)
    shutil.rmtree(log)                                   # the data is there, the watermark is not
    step(src, 2)
    more = src.union(spark.range(5, 7).select("id", F.lit(dt.datetime(2024, 3, 3)).alias("ingestion_dt")))
    step(more, 3)
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == list(range(7))
    assert inc.watermark_summary(spark.read.parquet(log)).first()["execucoes"] == 2


def est_line(ordem, mark, uf="SP", status="02", dv="90"):
    return (f'"12345678";"{ordem}";"{dv}";"{mark}";"ACME";"{status}";"20200101";"0";"";"";"20200101";"4711302";"";'
            f'"RUA";"X";"1";"";"C";"01000000";"{uf}";"7107";"11";"1";"";"";"";"";"";"";""')


def test_second_registry_load(spark, tmp_path):
    landing, lake = str(tmp_path / "zips"), jobs.Lake(str(tmp_path / "lake"))
    registry_landing(landing)
    zip_member(landing, "Simples.zip", "K.SIMPLES", ['"12345678";"S";"20200101";"";"N";"";""'])
    run1, run2 = dt.datetime(2024, 3, 1, 6), dt.datetime(2024, 4, 1, 6)
    jobs.bronze_registry(spark, landing, lake, run1)
    jobs.silver_registry(spark, lake, run1)
    zip_member(landing, "Empresas7.zip", "K.EMPRECSV", ['" 12345678 ";"ACME NOVA";"2062 ";"49";"2000,00";"";""',
                                                        '"33333333";"short"', '"44444444";"Line\nbreak; SA";"2062";"49";"1,00";"01";""'])
    zip_member(landing, "Estabelecimentos7.zip", "K.ESTABELE", [est_line("0001", 1), est_line("0002", 2, "RJ", dv="70"), est_line("0003", 2, "RJ")])
    zip_member(landing, "Simples7.zip", "K.SIMPLES", ['"12345678";"N";"20200101";"20240101";"N";"";""'])
    st = {r["tabela"]: r for r in jobs.bronze_registry(spark, landing, lake, run2).collect()}
    assert (st["empresas"]["registros"], st["empresas"]["rejeitados"]) == (2, 1)
    assert st["naturezas"]["registros"] == 0
    assert [r["linha"] for r in stored_rejects(spark, lake.quarantine("empresas")).collect()] == ['"33333333";"short"']
    jobs.silver_registry(spark, lake, run2)
    comp = {r["CNPJ_BASICO"]: r for r in spark.read.parquet(lake.silver("empresas_tratado")).collect()}
    assert set(comp) == {"12345678", "01234567", "22222222", "44444444"}
    assert float(comp["12345678"]["CAPITAL_SOCIAL_DA_EMPRESA"]) == 2000.0
    assert comp["12345678"]["PORTE_DA_EMPRESA"] == "NAO INFORMADO" and comp["12345678"]["NATUREZA_JURIDICA"] == "2062"
    assert spark.read.parquet(lake.silver("simples_tratado")).first()["OPCAO_PELO_SIMPLES"] == "N"
    est = {r["CNPJ_ORDEM"]: r for r in spark.read.parquet(lake.silver("estabelecimentos_tratado"))
           .where("CNPJ_BASICO = '12345678'").collect()}
    assert set(est) == {"0001", "0002", "0003"}
    jobs.gold_registry(spark, lake, run2)
    assert spark.table("vw_empresa_completa").where("CO_CNPJ_BASICO = '12345678'").count() == 3
    # a full refresh reads everything again and changes nothing
    jobs.bronze_registry(spark, landing, lake, dt.datetime(2024, 5, 1), mode="full")
    jobs.silver_registry(spark, lake, dt.datetime(2024, 5, 1))
    assert spark.read.parquet(lake.silver("empresas_tratado")).count() == 4


def test_loaded_archives_are_not_opened_again(spark, tmp_path):
    landing, lake = str(tmp_path / "zips"), jobs.Lake(str(tmp_path / "lake"))
    registry_landing(landing)
    jobs.bronze_registry(spark, landing, lake, dt.datetime(2024, 3, 1))
    for name in os.listdir(landing):                     # unreadable now: opening one would fail
        with open(os.path.join(landing, name), "wb") as fh:
            fh.write(b"not a zip")
    st = jobs.bronze_registry(spark, landing, lake, dt.datetime(2024, 3, 2)).collect()
    assert all(r["status"] in ("ok", "skipped") and r["registros"] == 0 for r in st), st


def test_gold_registry_reports_missing_inputs(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path / "lake"))
    assert {r["status"] for r in jobs.gold_registry(spark, lake, dt.datetime(2024, 3, 1)).collect()} == {"skipped"}


def test_long_codes_are_not_cut(spark):
    bronze = spark.createDataFrame([("12345", "a"), ("12346", "b"), ("7", "c")], "CODIGO string, DESCRICAO string")
    assert sorted(r["CODIGO"] for r in jobs.silver_codes(bronze, 4).collect()) == ["0007", "12345", "12346"]


def test_product_codes_keep_no_provenance(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    trade_landing(landing)
    run = dt.datetime(2024, 3, 1, 6)
    jobs.bronze_trade(spark, landing, lake, run)
    jobs.silver_trade(spark, lake, run)
    for t in ("ncm_tratado", "pais_tratado", "uf_mun_tratado"):
        assert not {c.lower() for c in spark.read.parquet(lake.silver(t)).columns} & set(S.PROVENANCE_COLUMNS), t


def test_a_product_that_comes_later_reaches_old_facts(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    trade_landing(landing)
    days = [dt.datetime(2024, 3, d, 6) for d in (1, 2)]
    for step in (lambda d: jobs.bronze_trade(spark, landing, lake, d, key="version"),
                 lambda d: jobs.silver_trade(spark, lake, d), lambda d: jobs.gold_trade(spark, lake, d)):
        step(days[0])
    unknown = lambda: spark.read.parquet(lake.gold("fato_balanca_exp")).where("CO_NCM = '99999999'").first()
    assert unknown()["fk_produto"] is None
    with open(f"{landing}/NCM.csv", "ab") as fh:
        fh.write(b"99999999;10;1;1;1;2;1;111;1;111;1;Novo;x;y\r\n")
    for step in (lambda d: jobs.bronze_trade(spark, landing, lake, d, key="version"),
                 lambda d: jobs.silver_trade(spark, lake, d), lambda d: jobs.gold_trade(spark, lake, d)):
        step(days[1])
    assert unknown()["fk_produto"] is not None
    assert spark.read.parquet(lake.gold("fato_balanca_exp")).count() == 3


def test_tables_by_name(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    trade_landing(landing)
    run = dt.datetime(2024, 3, 1, 6)
    jobs.bronze_trade(spark, landing, lake, run)
    jobs.silver_trade(spark, lake, run)
    try:
        for _ in range(2):
            out = jobs.register_tables(spark, lake, "t_silver", "t_gold").collect()
            assert out and all(r["status"] == "ok" for r in out), out
        assert spark.table("t_silver.exp_tratado").count() == 3
        assert spark.table("t_silver.ncm_tratado").count() == 1
    finally:
        for d in ("t_silver", "t_gold"):
            spark.sql(f"DROP DATABASE IF EXISTS {d} CASCADE")


def test_one_broken_dimension_leaves_the_others_built(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    trade_landing(landing)
    run = dt.datetime(2024, 3, 1, 6)
    jobs.bronze_trade(spark, landing, lake, run)
    jobs.silver_trade(spark, lake, run)
    import shutil
    shutil.rmtree(lake.silver("pais_tratado"))
    spark.range(1).write.mode("overwrite").parquet(lake.silver("uf_tratado"))   # its columns are gone
    st = {r["tabela"]: (r["status"], r["mensagem"]) for r in jobs.gold_trade(spark, lake, run).collect()}
    assert st["pais_tratado"] == ("skipped", "silver table missing")
    assert st["dim_geografia"] == ("skipped", "needs pais_tratado") and st["dim_localidade_br"][0] == "error"
    assert st["dim_tempo"][0] == st["dim_produto"][0] == "ok"
    assert st["fato_balanca_exp"] == ("skipped", "needs dim_geografia")
    assert st["vw_balanca_comercial_consolidada"][0] == "skipped"
    assert spark.read.parquet(lake.gold("dim_produto")).count() == 1


def test_refresh_that_leaves_nothing(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    write(f"{landing}/EXP_2024.csv", EXP_HEADER + "\r\n2024;1;1;10;023;SP;1;1;3;10;100\r\n")
    days = [dt.datetime(2024, 3, d, 6) for d in (1, 2)]
    jobs.bronze_trade(spark, landing, lake, days[0])
    jobs.silver_trade(spark, lake, days[0])
    write(f"{landing}/EXP_2024.csv", EXP_HEADER + "\r\nonly;bad\r\n")
    jobs.bronze_trade(spark, landing, lake, days[1], mode="full")
    jobs.silver_trade(spark, lake, days[1])
    left = spark.read.schema(jobs.SILVER_TRADE["EXP"]).parquet(lake.silver("exp_tratado"))
    assert left.count() == 0
    assert inc.committed_rejects(spark, lake.quarantine("exp"), lake.manifest, "EXP").count() == 1
    assert stored_rejects(spark, lake.quarantine("exp")).count() == 1


def test_quarantine_after_a_crash_and_its_rerun(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), jobs.Lake(str(tmp_path / "lake"))
    write(f"{landing}/EXP_2024.csv", EXP_HEADER + "\r\n2024;1;1;10;023;SP;1;1;3;10;100\r\nshort;line\r\n")
    jobs.bronze_trade(spark, landing, lake, dt.datetime(2024, 3, 1))
    drop_manifest_rows(spark, lake, "EXP")
    jobs.bronze_trade(spark, landing, lake, dt.datetime(2024, 3, 2))
    assert stored_rejects(spark, lake.quarantine("exp")).count() == 2
    assert inc.committed_rejects(spark, lake.quarantine("exp"), lake.manifest, "EXP").count() == 1
