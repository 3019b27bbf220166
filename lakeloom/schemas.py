"""Source-file column lists and control-table layouts (bronze contracts).

Fixed values that must equal the source datasets' layouts for equal results:
column names and order of each delimited source file.
"""

from __future__ import annotations

# Trade files (header-bearing, ';', ISO-8859-1).
EXPORT_COLUMNS = ["CO_ANO", "CO_MES", "CO_NCM", "CO_UNID", "CO_PAIS", "SG_UF_NCM", "CO_VIA", "CO_URF",
                  "QT_ESTAT", "KG_LIQUIDO", "VL_FOB"]
IMPORT_COLUMNS = EXPORT_COLUMNS + ["VL_FRETE", "VL_SEGURO"]
PRODUCT_COLUMNS = ["CO_NCM", "CO_UNID", "CO_SH6", "CO_PPE", "CO_PPI", "CO_FAT_AGREG", "CO_CUCI_ITEM",
                   "CO_CGCE_N3", "CO_SIIT", "CO_ISIC_CLASSE", "CO_EXP_SUBSET", "NO_NCM_POR", "NO_NCM_ESP",
                   "NO_NCM_ING"]

# Columns of the product codes that silver does not keep.
PRODUCT_UNUSED = ["NO_NCM_ESP", "NO_NCM_ING", "CO_PPE", "CO_PPI", "CO_SIIT"]

# Company registry files (headerless, ';', quoted, ISO-8859-1, inside ZIP archives).
COMPANY_COLUMNS = ["CNPJ_BASICO", "RAZAO_SOCIAL_NOME_EMPRESARIAL", "NATUREZA_JURIDICA",
                   "QUALIFICACAO_DO_RESPONSAVEL", "CAPITAL_SOCIAL_DA_EMPRESA", "PORTE_DA_EMPRESA",
                   "ENTE_FEDERATIVO_RESPONSAVEL"]
ESTABLISHMENT_COLUMNS = ["CNPJ_BASICO", "CNPJ_ORDEM", "CNPJ_DV", "IDENTIFICADOR_MATRIZ_FILIAL", "NOME_FANTASIA",
                         "SITUACAO_CADASTRAL", "DATA_SITUACAO_CADASTRAL", "MOTIVO_SITUACAO_CADASTRAL",
                         "NOME_CIDADE_EXTERIOR", "PAIS", "DT_INICIO_ATIVIDADE", "CNAE_FISCAL_PRINCIPAL",
                         "CNAE_FISCAL_SECUNDARIA", "TIPO_LOGRADOURO", "LOGRADOURO", "NUMERO", "COMPLEMENTO",
                         "BAIRRO", "CEP", "UF", "MUNICIPIO", "DDD1", "TELEFONE1", "DDD2", "TELEFONE2", "DDD_FAX",
                         "FAX", "CORREIO_ELETRONICO", "SITUACAO_ESPECIAL", "DATA_SITUACAO_ESPECIAL"]
# Columns of the establishments that silver does not keep (contacts, addresses).
ESTABLISHMENT_UNUSED = ["DDD1", "TELEFONE1", "DDD2", "TELEFONE2", "DDD_FAX", "FAX", "CORREIO_ELETRONICO",
                        "SITUACAO_ESPECIAL", "DATA_SITUACAO_ESPECIAL", "COMPLEMENTO", "NUMERO", "TIPO_LOGRADOURO",
                        "LOGRADOURO", "BAIRRO"]
SIMPLES_COLUMNS = ["CNPJ_BASICO", "OPCAO_PELO_SIMPLES", "DATA_DE_OPCAO_PELO_SIMPLES", "DATA_DE_EXCLUSAO_DO_SIMPLES",
                   "OPCAO_PELO_MEI", "DATA_DE_OPCAO_PELO_MEI", "DATA_DE_EXCLUSAO_DO_MEI"]
PARTNER_COLUMNS = ["CNPJ_BASICO", "IDENTIFICADOR_DO_SOCIO", "NOME_DO_SOCIO", "CPF_CNPJ_DO_SOCIO",
                   "QUALIFICACAO_DO_SOCIO", "DATA_DE_ENTRADA_NA_SOCIEDADE", "PAIS", "REPRESENTANTE_LEGAL",
                   "NOME_DO_REPRESENTANTE_LEGAL", "QUALIFICACAO_DO_REPRESENTANTE_LEGAL", "FAIXA_ETARIA"]
CODE_COLUMNS = ["CODIGO", "DESCRICAO"]

# Archive group (file name without digits) -> bronze table and its columns.
REGISTRY_GROUPS = {
    "Empresas": ("empresas", COMPANY_COLUMNS),
    "Estabelecimentos": ("estabelecimentos", ESTABLISHMENT_COLUMNS),
    "Simples": ("simples", SIMPLES_COLUMNS),
    "Socios": ("socios", PARTNER_COLUMNS),
    "Paises": ("paises", CODE_COLUMNS),
    "Municipios": ("municipios", CODE_COLUMNS),
    "Qualificacoes": ("qualificacoes", CODE_COLUMNS),
    "Naturezas": ("naturezas", CODE_COLUMNS),
    "Cnaes": ("cnaes", CODE_COLUMNS),
    "Motivos": ("motivos", CODE_COLUMNS),
}

# Columns every bronze table gains (C3/C4) and that silver drops with one shared list (Q30).
PROVENANCE_COLUMNS = ["origin_path_name", "file_name_only", "origin_file_name", "ingestion_dt", "dt_ingestao",
                      "batch_id", "tipo_operacao", "anomes", "ano", "mes"]
