"""Topic and skip lists and seed addresses of the page feeds."""

from __future__ import annotations

AWS_SKIPPED = ("/release-notes/", "/api-reference/", "/cli/", "/APIReference/")
WAREHOUSE_SKIPPED = ("/en/release-notes/",)
MIGRATION_SKIPPED = ("/release-notes/", "/api-reference/", "/changelog/", "/whats-new/")

AWS_TOPICS = tuple("""
architecture design best-practice well-architected high-availability fault-tolerant
disaster-recovery resilient scalable scalability elastic auto-scaling
security encryption iam policy role permission access-control authentication authorization identity
kms key-management ssl tls certificate vpc subnet security-group network-acl firewall
mfa multi-factor compliance audit
networking route gateway endpoint load-balancer elb alb nlb cloudfront cdn
direct-connect vpn transit-gateway peering dns route53 hosted-zone
storage s3 bucket object ebs volume snapshot efs fsx glacier lifecycle replication versioning
storage-class tiering backup archive
database rds aurora dynamodb elasticache read-replica multi-az failover restore
performance scaling capacity throughput
compute ec2 instance ami launch lambda serverless container ecs eks fargate
spot reserved on-demand savings-plan
integration sqs sns eventbridge step-functions api-gateway rest websocket microservices decoupling
message queue topic event
monitoring cloudwatch metrics alarm log trace cloudtrail config systems-manager parameter-store
secrets-manager cloudformation infrastructure-as-code
cost pricing billing budget optimization savings cost-explorer
migration transfer datasync dms snowball hybrid on-premises lift-and-shift
analytics data-lake etl glue athena redshift kinesis streaming batch emr spark
getting-started concepts overview how-it-works tutorial use-case scenario example
quotas limits regions availability-zones
""".split())

WAREHOUSE_TOPICS = tuple("""
warehouses tables data-load data-unload security account user-management sql-reference performance
data-sharing database schemas views cloning time-travel fail-safe streams tasks stored-procedures
functions stages file-format pipes resource-monitors roles privileges authentication
network-policies encryption caching clustering materialized-views transactions query-syntax
data-types
""".split())

DBT_TOPICS = tuple("""
models sources tests snapshots seeds macros
incremental incremental-strategy merge insert-overwrite on_schema_change unique_key partition
jinja ref source var env_var run_query statement adapter execute
join union filter aggregate window deduplication surrogate-key hash
project profiles dbt_project packages dependencies config schema database alias
table view ephemeral materialized
generic-tests singular-tests not_null unique accepted_values relationships dbt-expectations
elementary hooks operations on-run-start on-run-end contracts constraints grants
snowflake-configs bigquery-configs redshift-configs databricks-configs merge-behavior
run test compile debug build deps generate serve documentation
introduction getting-started tutorial best-practice style-guide project-structure
""".split())

IICS_TOPICS = tuple("""
mapping mapping-overview mapping-task source-transformation target-transformation
expression-transformation filter-transformation joiner-transformation aggregator-transformation
router-transformation lookup-transformation union-transformation sorter-transformation
rank-transformation update-strategy-transformation sequence-generator normalizer-transformation
hierarchy-parser hierarchy-builder data-masking-transformation validate-transformation
transformation expression filter joiner sorter aggregator router union lookup rank normalizer
update-strategy parameter variable mapping-parameter input-field parameterization
pushdown pushdown-optimization sql-override connector connection source target
snowflake redshift bigquery s3 oracle sql-server mysql postgresql salesforce jdbc
powercenter migration migrate convert import pc-to-iics upgrade
expression-language built-in-function string-function date-function numeric-function null-function
decode iif in instr ltrim rtrim to_date to_char trunc sysdate
cdc change-data-capture incremental delta insert update delete upsert
overview introduction getting-started concepts best-practice example guide
""".split())

# fixed values: seed addresses by service
SEEDS: dict[str, tuple[str, ...]] = {
    "dbt-core": (
        "https://docs.getdbt.com/docs/introduction",
        "https://docs.getdbt.com/docs/build/models",
        "https://docs.getdbt.com/docs/build/sql-models",
        "https://docs.getdbt.com/docs/build/python-models",
        "https://docs.getdbt.com/docs/build/sources",
        "https://docs.getdbt.com/docs/build/tests",
        "https://docs.getdbt.com/docs/build/snapshots",
        "https://docs.getdbt.com/docs/build/jinja-macros",
        "https://docs.getdbt.com/reference/model-configs",
        "https://docs.getdbt.com/reference/source-configs",
        "https://docs.getdbt.com/reference/project-configs",
        "https://docs.getdbt.com/reference/dbt-commands",
        "https://docs.getdbt.com/reference/resource-configs/incremental_strategy",
        "https://docs.getdbt.com/reference/resource-configs/on_schema_change",
        "https://docs.getdbt.com/docs/build/incremental-models",
        "https://docs.getdbt.com/docs/build/incremental-strategy",
        "https://docs.getdbt.com/reference/resource-configs/snowflake-configs",
        "https://docs.getdbt.com/reference/resource-configs/bigquery-configs",
        "https://docs.getdbt.com/reference/resource-configs/redshift-configs",
        "https://docs.getdbt.com/docs/build/hooks-operations",
        "https://docs.getdbt.com/reference/resource-configs/grants",
        "https://docs.getdbt.com/docs/build/contracts",
        "https://docs.getdbt.com/docs/build/packages",
        "https://docs.getdbt.com/reference/dbt-jinja-functions/ref",
        "https://docs.getdbt.com/reference/dbt-jinja-functions/source",
        "https://docs.getdbt.com/reference/dbt-jinja-functions/var",
        "https://docs.getdbt.com/reference/dbt-jinja-functions/env_var",
        "https://docs.getdbt.com/reference/dbt-jinja-functions/run_query",
    ),
    "iics-data-integration": (
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/mappings/mappings-overview.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/mapping-tasks/mapping-tasks-overview.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/transformations-overview.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/expression-transformation.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/filter-transformation.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/joiner-transformation.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/aggregator-transformation.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/router-transformation.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/lookup-transformation.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/union-transformation.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/sorter-transformation.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/rank-transformation.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/update-strategy-transformation.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/sequence-generator-transformation.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/transformations/normalizer-transformation.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/mapping-parameters-and-variables/mapping-parameters-and-variables-overview.html",
        "https://docs.informatica.com/integration-cloud/data-integration/current-version/pushdown-optimization/pushdown-optimization-overview.html",
    ),
    "iics-pc-migration": (
        "https://docs.informatica.com/data-integration/powercenter/current-version/pc-to-iics-migration-guide/migration-overview.html",
    ),
}
