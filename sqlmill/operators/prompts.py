"""Prompt texts as Column expressions.

Templates are split at ``${name}`` placeholders and rendered with ``concat``,
so prompts are built JVM-side for any number of rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: prompt templates (must equal the reference's text) ---------
SYSTEM_PROMPT = ("你是一个专业的SQL专家，能够将自然语言问题转换为准确的SQL查询语句。\n"
                 "请根据用户的问题，生成对应的SQL查询语句。只输出SQL语句，不要包含任何解释。")
CHAT_SYSTEM_PROMPT = ("你是一个专业的SQL专家，能够将自然语言问题转换为准确的SQL查询语句。"
                      "请根据用户的问题，生成对应的SQL查询语句。只输出SQL语句，不要包含任何解释。")
TRAIN_TEMPLATE = "${system}\n\n### 问题:\n${question}\n\n### SQL:\n${sql}"
INFER_TEMPLATE = "${system}\n\n### 问题:\n${question}\n\n### SQL:\n"

PLANNING_TEMPLATE = """你是数据库分析专家。以下是数据库表卡片摘要：

${cards}

请基于以上数据库结构，规划出若干个业务主题（topics），每个主题选择${min_tables}~${max_tables}张相关联的表，用于生成NL2SQL训练样本。

要求：
1. 主题应该覆盖不同的业务场景（如：用户分析、订单统计、销售报表等）
2. 每个主题的表应该有业务关联性（通过外键或业务逻辑相关）
3. 所有主题的生成样本数总和必须等于 ${total}
4. 每个主题至少分配 20 个样本

请输出一个JSON格式的规划，格式如下：
{
  "topics": [
    {
      "name": "主题名称",
      "tables": ["table1", "table2", "table3"],
      "reason": "选择这些表的理由",
      "count": 100,
      "dialect": "${dialect}"
    }
  ]
}

注意：
- 仅输出JSON，不要包含任何解释文字
- 确保所有count之和等于${total}
- 确保所有表名都在上述表卡片中存在
"""

GENERATION_TEMPLATE = """你是SQL开发专家。请基于以下数据库表结构，生成 ${count} 条关于"${topic}"主题的自然语言问题及对应的SQL查询。

SQL方言: ${dialect}

数据库表结构:
${ddl}

要求:
1. 生成的SQL必须可执行，不要虚构表名或字段名
2. 仅使用上述表结构中的表和字段
3. 问题应该多样化，包括：简单查询、聚合统计、JOIN关联、WHERE条件、GROUP BY分组、ORDER BY排序等
4. 每条样本输出一行JSON格式: {"input":"自然语言问题","output":"SQL语句"}
5. 不要添加任何解释文字，只输出JSON行

示例格式:
{"input":"查询所有用户的姓名和邮箱","output":"SELECT name, email FROM users;"}
{"input":"统计每个城市的用户数量","output":"SELECT city, COUNT(*) as user_count FROM users GROUP BY city;"}

请开始生成 ${count} 条样本:
"""
# --- end of fixed values ------------------------------------------------------

_PH = re.compile(r"\$\{(\w+)\}")


def render(template: str, **values) -> Column:
    """``concat`` of the template's literal pieces and the given Columns/values."""
    parts, last = [], 0
    for m in _PH.finditer(template):
        if m.start() > last:
            parts.append(F.lit(template[last:m.start()]))
        v = values[m.group(1)]
        parts.append(v.cast("string") if isinstance(v, Column) else F.lit(str(v)))
        last = m.end()
    if last < len(template):
        parts.append(F.lit(template[last:]))
    return F.concat(*parts)


def build_prompt(question, sql=None, training: bool = True) -> Column:
    """Training prompt (with the answer) or inference prompt."""
    q = F.col(question) if isinstance(question, str) else question
    if training:
        s = F.col(sql) if isinstance(sql, str) else sql
        return render(TRAIN_TEMPLATE, system=SYSTEM_PROMPT, question=q, sql=F.coalesce(s, F.lit("None")))
    return render(INFER_TEMPLATE, system=SYSTEM_PROMPT, question=q)


def build_chat_prompt(question) -> Column:
    """[system, user] messages as ``array<struct<role, content>>``."""
    q = F.col(question) if isinstance(question, str) else question
    return F.array(F.struct(F.lit("system").alias("role"), F.lit(CHAT_SYSTEM_PROMPT).alias("content")),
                   F.struct(F.lit("user").alias("role"), q.alias("content")))


def planning_prompt(cards, total, min_tables, max_tables, dialect) -> Column:
    """N6."""
    return render(PLANNING_TEMPLATE, cards=cards, total=total, min_tables=min_tables,
                  max_tables=max_tables, dialect=dialect)


def generation_prompt(topic, ddl, count, dialect) -> Column:
    """N7."""
    return render(GENERATION_TEMPLATE, topic=topic, ddl=ddl, count=count, dialect=dialect)
