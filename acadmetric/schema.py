"""The evaluation schema: column types, keys and data rules of every table.

Spark does not enforce any of these rules on files, so they are data here and
jobs in ``operators.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    required: bool = True
    max_length: int | None = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    unique: tuple[str, ...] = ()
    # column -> (parent table, parent column)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    # column -> closed list of codes
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    # column -> (lowest, highest); None leaves the side open
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    # (start column, end column)
    periods: tuple[tuple[str, str], ...] = ()

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, not c.required) for c in self.columns])


def _id(name: str, required: bool = True) -> Column:
    return Column(name, T.IntegerType(), required)


def _text(name: str, length: int | None = None, required: bool = True) -> Column:
    return Column(name, T.StringType(), required, length)


def _date(name: str, required: bool = True) -> Column:
    return Column(name, T.DateType(), required)


def _number(name: str, precision: int, scale: int, required: bool = True) -> Column:
    return Column(name, T.DecimalType(precision, scale), required)


_ACTIVE = _text("st_registro_ativo", 1)

# Column names, lengths, keys and the closed code lists of the schema, which stored tables must match.
YES_NO = ("S", "N")
DEGREES = ("GR", "ES", "ME", "DO", "PD")
EVENT_TYPES = ("CO", "SE", "WO", "SI")
COLLABORATION_TYPES = ("MO", "CT", "PJ")
PROGRAM_LEVELS = ("ME", "DO", "MP")
STUDENT_LEVELS = ("ME", "DO")
STUDENT_STATUS = ("AT", "TI", "DE")
OUTPUT_TYPES = ("AR", "LI", "CA", "AN")
QUALIS = ("A1", "A2", "A3", "A4", "B1", "B2", "B3", "B4")
PROJECT_STATUS = ("AT", "CO", "CA")
INDICATOR_TYPES = ("PD", "FE", "II", "IS")
REPORT_TYPES = ("AN", "QU")
LINK_TYPES = ("PE", "CO", "VI")
AUTHOR_ROLES = ("AP", "CA")

_PROGRAM = ("tb_programa", "co_seq_programa")
_AREA = ("tb_area_avaliacao", "co_seq_area")
_FACULTY = ("tb_docente", "co_seq_docente")

_TABLES = (
    Table(
        "tb_instituicao",
        (_id("co_seq_instituicao"), _text("nm_instituicao", 200), _text("nu_cnpj", 14), _text("sg_uf", 2),
         _text("nm_cidade", 100), _ACTIVE),
        key=("co_seq_instituicao",),
        unique=("nu_cnpj",),
        domains={"st_registro_ativo": YES_NO},
    ),
    Table(
        "tb_area_avaliacao",
        (_id("co_seq_area"), _text("nm_area", 100), _text("co_area_capes", 10)),
        key=("co_seq_area",),
        unique=("co_area_capes",),
    ),
    Table(
        "tb_docente",
        (_id("co_seq_docente"), _text("nm_docente", 200), _text("nu_cpf", 11), _text("ds_titulacao", 2),
         _text("nm_area_atuacao", 100, False), _ACTIVE),
        key=("co_seq_docente",),
        unique=("nu_cpf",),
        domains={"ds_titulacao": DEGREES, "st_registro_ativo": YES_NO},
    ),
    Table(
        "tb_evento",
        (_id("co_seq_evento"), _text("nm_evento", 200), _text("tp_evento", 2), _text("nm_local", 200, False),
         _date("dt_inicio", False), _date("dt_fim", False)),
        key=("co_seq_evento",),
        domains={"tp_evento": EVENT_TYPES},
        periods=(("dt_inicio", "dt_fim"),),
    ),
    Table(
        "tb_colaboracao_internacional",
        (_id("co_seq_colaboracao"), _text("nm_instituicao_parceira", 200), _text("nm_pais", 100),
         _text("tp_colaboracao", 2), _date("dt_inicio", False), _date("dt_fim", False)),
        key=("co_seq_colaboracao",),
        domains={"tp_colaboracao": COLLABORATION_TYPES},
        periods=(("dt_inicio", "dt_fim"),),
    ),
    Table(
        "tb_programa",
        (_id("co_seq_programa"), _text("nm_programa", 200), _text("co_programa_capes", 20), _text("tp_nivel", 2),
         _id("co_seq_instituicao"), _id("co_seq_area"), _ACTIVE),
        key=("co_seq_programa",),
        unique=("co_programa_capes",),
        references={"co_seq_instituicao": ("tb_instituicao", "co_seq_instituicao"), "co_seq_area": _AREA},
        domains={"tp_nivel": PROGRAM_LEVELS, "st_registro_ativo": YES_NO},
    ),
    Table(
        "tb_discente",
        (_id("co_seq_discente"), _text("nm_discente", 200), _text("nu_cpf", 11), _text("tp_nivel", 2),
         _id("co_seq_programa"), _id("co_seq_docente_orientador"), _date("dt_ingresso"),
         _date("dt_previsao_defesa", False), _text("tp_status", 2), _ACTIVE),
        key=("co_seq_discente",),
        unique=("nu_cpf",),
        references={"co_seq_programa": _PROGRAM, "co_seq_docente_orientador": _FACULTY},
        domains={"tp_nivel": STUDENT_LEVELS, "tp_status": STUDENT_STATUS, "st_registro_ativo": YES_NO},
    ),
    Table(
        "tb_egresso",
        (_id("co_seq_egresso"), _text("nm_egresso", 200), _text("nu_cpf", 11), _id("co_seq_programa"),
         _date("dt_titulacao"), _text("ds_atuacao_profissional", 200, False),
         _text("nm_instituicao_atual", 200, False), _ACTIVE),
        key=("co_seq_egresso",),
        unique=("nu_cpf",),
        references={"co_seq_programa": _PROGRAM},
        domains={"st_registro_ativo": YES_NO},
    ),
    Table(
        "tb_producao_cientifica",
        (_id("co_seq_producao"), _text("nm_titulo", 500), _text("tp_producao", 2), _text("nm_veiculo", 200, False),
         _text("ds_qualis", 2, False), _id("nu_ano_publicacao"), _text("ds_doi", 100, False),
         _id("co_seq_evento", False), _ACTIVE),
        key=("co_seq_producao",),
        references={"co_seq_evento": ("tb_evento", "co_seq_evento")},
        domains={"tp_producao": OUTPUT_TYPES, "ds_qualis": QUALIS, "st_registro_ativo": YES_NO},
    ),
    Table(
        "tb_projeto_pesquisa",
        (_id("co_seq_projeto"), _text("nm_projeto", 300), _text("ds_financiador", 100, False),
         _number("vl_financiamento", 15, 2, False), _id("co_seq_programa"), _date("dt_inicio"),
         _date("dt_fim", False), _text("tp_status", 2), _ACTIVE),
        key=("co_seq_projeto",),
        references={"co_seq_programa": _PROGRAM},
        domains={"tp_status": PROJECT_STATUS, "st_registro_ativo": YES_NO},
        ranges={"vl_financiamento": (0, None)},
        periods=(("dt_inicio", "dt_fim"),),
    ),
    Table(
        "tb_criterio_avaliacao",
        (_id("co_seq_criterio"), _id("co_seq_area"), _text("nm_criterio", 100), _number("vl_peso", 5, 2),
         _text("ds_criterio", None, False)),
        key=("co_seq_criterio",),
        references={"co_seq_area": _AREA},
        ranges={"vl_peso": (0, 100)},
    ),
    Table(
        "tb_indicador",
        (_id("co_seq_indicador"), _id("co_seq_programa"), _id("nu_ano_referencia"), _text("tp_indicador", 2),
         _number("vl_indicador", 10, 4, False)),
        key=("co_seq_indicador",),
        references={"co_seq_programa": _PROGRAM},
        domains={"tp_indicador": INDICATOR_TYPES},
    ),
    Table(
        "tb_avaliador",
        (_id("co_seq_avaliador"), _text("nm_avaliador", 200), _text("nu_cpf", 11), _id("co_seq_area"),
         _text("nm_instituicao_origem", 200, False)),
        key=("co_seq_avaliador",),
        unique=("nu_cpf",),
        references={"co_seq_area": _AREA},
    ),
    Table(
        "tb_parecer",
        (_id("co_seq_parecer"), _id("co_seq_avaliador"), _id("co_seq_programa"), _id("nu_ano_avaliacao"),
         _number("vl_nota", 4, 2), _text("ds_parecer", None, False), _date("dt_emissao")),
        key=("co_seq_parecer",),
        references={"co_seq_avaliador": ("tb_avaliador", "co_seq_avaliador"), "co_seq_programa": _PROGRAM},
        ranges={"vl_nota": (0, 10)},
    ),
    Table(
        "tb_relatorio",
        (_id("co_seq_relatorio"), _id("co_seq_programa"), _id("nu_ano_referencia"), _text("tp_relatorio", 2),
         _id("nu_conceito_final", False), _date("dt_geracao")),
        key=("co_seq_relatorio",),
        references={"co_seq_programa": _PROGRAM},
        domains={"tp_relatorio": REPORT_TYPES},
        ranges={"nu_conceito_final": (1, 7)},
    ),
    Table(
        "rt_programa_docente",
        (_id("co_seq_programa"), _id("co_seq_docente"), _text("tp_vinculo", 2), _date("dt_inicio_vinculo"),
         _date("dt_fim_vinculo", False)),
        key=("co_seq_programa", "co_seq_docente"),
        references={"co_seq_programa": _PROGRAM, "co_seq_docente": _FACULTY},
        domains={"tp_vinculo": LINK_TYPES},
        periods=(("dt_inicio_vinculo", "dt_fim_vinculo"),),
    ),
    Table(
        "rt_producao_docente",
        (_id("co_seq_producao"), _id("co_seq_docente"), _text("tp_participacao", 2)),
        key=("co_seq_producao", "co_seq_docente"),
        references={"co_seq_producao": ("tb_producao_cientifica", "co_seq_producao"), "co_seq_docente": _FACULTY},
        domains={"tp_participacao": AUTHOR_ROLES},
    ),
    Table(
        "rt_projeto_colaboracao",
        (_id("co_seq_projeto"), _id("co_seq_colaboracao")),
        key=("co_seq_projeto", "co_seq_colaboracao"),
        references={"co_seq_projeto": ("tb_projeto_pesquisa", "co_seq_projeto"),
                    "co_seq_colaboracao": ("tb_colaboracao_internacional", "co_seq_colaboracao")},
    ),
    Table(
        "au_operacao",
        (_id("co_seq_auditoria"), Column("au_dt_operacao", T.TimestampNTZType()), _text("au_tp_operacao", 1),
         _text("au_nm_tabela", 30), _text("au_ds_chave_registro", 100, False),
         _text("au_ds_usuario_sessao", 50, False), _text("au_nu_ip_sessao", 45, False),
         _text("au_ds_usuario_aplicacao", 50, False), _text("au_ds_dados_anteriores", None, False),
         _text("au_ds_dados_novos", None, False)),
        key=("co_seq_auditoria",),
    ),
    Table(
        "bench_resultado",
        (_text("et_fase", 10), _text("co_consulta", 10), _id("nu_execucao"), _number("vl_tempo_ms", 12, 3),
         Column("dt_registro", T.TimestampNTZType())),
        key=(),
    ),
)

TABLES: dict[str, Table] = {table.name: table for table in _TABLES}
