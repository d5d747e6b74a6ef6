"""Analytic views and the questions asked of them."""

from __future__ import annotations

from lodestrata.operators import analysis, gold
from lodestrata.operators.integrate import state_indicator
from workload.data import Data
from workload.oracle import IN_FORCE, hit, mean2, r2
from workload.registry import query


@query("SELECT * FROM {v1}")
def gold_indicador_municipio(d: Data):
    return gold.indicador_municipio(d.integrated, d.alunos)


@query("SELECT * FROM {v2}")
def gold_meta_vs_resultado(d: Data):
    return gold.meta_vs_resultado(d.integrated, d.uf)


@query("SELECT * FROM {v3}")
def gold_evolucao_temporal(d: Data):
    return gold.evolucao_temporal(d.integrated)


@query("SELECT * FROM {student_totals}")
def student_totals(d: Data):
    return gold.student_totals(d.alunos)


@query("""SELECT sigla_uf, ano, indicador_uf, CASE WHEN indicador_uf IS NOT NULL THEN CAST(dense_rank() OVER (
  PARTITION BY ano ORDER BY indicador_uf DESC NULLS LAST) AS INTEGER) END AS ranking_taxa FROM {state_rate}""")
def rank_dense(d: Data):
    return gold.with_dense_rank(state_indicator(d.meta_uf), "ano", "indicador_uf", "ranking_taxa")


@query(f"""SELECT *, {r2('100.0::DOUBLE * total_alfabetizados / total_alunos')} AS taxa_alfabetizacao_calc FROM (
  SELECT ano, id_municipio, count(id_aluno) AS total_alunos,
    count(*) FILTER (WHERE alfabetizado = '1') AS total_alfabetizados FROM {{alunos}} GROUP BY ano, id_municipio)""")
def gold_alunos(d: Data):
    return gold.gold_alunos(d.alunos)


TARGET_VIEW = f"""taxa_alfabetizacao, {IN_FORCE} AS meta_vigente, {r2(f'taxa_alfabetizacao - {IN_FORCE}')} AS gap_meta,
  {hit('taxa_alfabetizacao', IN_FORCE)} AS atingiu_meta"""


@query(f"SELECT ano, rede, {TARGET_VIEW} FROM {{meta_brasil}}")
def gold_meta_brasil(d: Data):
    return gold.gold_meta_brasil(d.meta_brasil)


@query(f"SELECT ano, sigla_uf, rede, {TARGET_VIEW} FROM {{meta_uf}}")
def gold_meta_uf(d: Data):
    return gold.gold_meta_uf(d.meta_uf)


@query(f"""SELECT *, {r2('taxa_alfabetizacao - antes')} AS delta_anual FROM (
  SELECT ano, id_municipio, sigla_uf, rede, nome_municipio, taxa_alfabetizacao, meta_vigente, gap2 AS gap_meta,
    hit AS atingiu_meta, lag(taxa_alfabetizacao) OVER (PARTITION BY id_municipio, rede ORDER BY ano) AS antes
  FROM {{base_gap}})""".replace("SELECT *,", "SELECT * EXCLUDE (antes),", 1))
def gold_meta_municipio(d: Data):
    return gold.gold_meta_municipio(d.integrated)


@query("""SELECT id_municipio, rede, nome, sigla_uf, ano, pct_alfabetizados, meta_pct, gap_meta FROM {v1}
WHERE atingiu_meta = false ORDER BY gap_meta ASC NULLS LAST, id_municipio, ano, rede LIMIT 10""")
def top_negative_gap(d: Data):
    return analysis.top_negative_gap(gold.indicador_municipio(d.integrated))


@query("""SELECT sigla_uf, ano, delta_percentual, taxa_media FROM {v2} WHERE delta_percentual IS NOT NULL
ORDER BY delta_percentual DESC, sigla_uf, ano LIMIT 10""")
def top_improvers(d: Data):
    return analysis.top_improvers(gold.meta_vs_resultado(d.integrated))


@query(f"SELECT ano, {mean2('pct_alfabetizados')} AS media_nacional FROM {{v3}} GROUP BY ano")
def national_evolution(d: Data):
    return analysis.national_evolution(gold.evolucao_temporal(d.integrated))


# The two questions below read their view twice (once for its latest year), so it is written first.


@query("""SELECT sigla_uf, regiao, taxa_media, meta_media, gap_medio, ranking_taxa FROM {v2}
WHERE ano = (SELECT max(ano) FROM {v2})""")
def ranking_latest_year(d: Data):
    return analysis.ranking_latest_year(gold.meta_vs_resultado(d.integrated, d.uf))


@query("""SELECT CAST(sum(municipios_acima_meta) AS BIGINT) AS total_acima_meta,
  CAST(sum(municipios_abaixo_meta) AS BIGINT) AS total_abaixo_meta FROM {v2} WHERE ano = (SELECT max(ano) FROM {v2})""")
def national_hit_totals(d: Data):
    return analysis.national_hit_totals(gold.meta_vs_resultado(d.integrated))


@query("""SELECT 'indicador_municipio' AS visao, true AS colunas_presentes, count(*) > 0 AS tem_linhas FROM {v1}
UNION ALL SELECT 'meta_vs_resultado', true, count(*) > 0 FROM {v2}
UNION ALL SELECT 'evolucao_temporal', true, count(*) > 0 FROM {v3}""")
def gold_contract(d: Data):
    views = {
        "indicador_municipio": gold.indicador_municipio(d.integrated, d.alunos),
        "meta_vs_resultado": gold.meta_vs_resultado(d.integrated, d.uf),
        "evolucao_temporal": gold.evolucao_temporal(d.integrated),
    }
    reports = [gold.view_contract(view, name) for name, view in views.items()]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])
