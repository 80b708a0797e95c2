"""Rules of the built-in sites.

FIXED VALUES: site addresses, category labels, selectors, JSON-LD paths, URL
patterns and publisher names below are data that has to be as it is for the
results to be right. ``hooks`` holds what a site does beyond its plain rules.
"""

SITES = {
    "clm": {
        "entry_points": [
            {"url": "https://www.theclm.org/Magazine/", "category": ""},
            {"url": "https://www.theclm.org/Magazine/topic/all", "category": "All"},
            {"url": "https://www.theclm.org/Magazine/Home/Archive", "category": "Archive"},
            {"url": "https://www.theclm.org/Magazine/topic/cannabis", "category": "Cannabis"},
            {"url": "https://www.theclm.org/Magazine/topic/claimsmanagement", "category": "Claims Management"},
            {"url": "https://www.theclm.org/Magazine/topic/cmpl", "category": "CMPL"},
            {"url": "https://www.theclm.org/Magazine/topic/construction", "category": "Construction"},
            {"url": "https://www.theclm.org/Magazine/topic/coverage", "category": "Coverage"},
            {"url": "https://www.theclm.org/Magazine/topic/dei", "category": "DEI"},
            {"url": "https://www.theclm.org/Magazine/topic/environmental", "category": "Environmental"},
            {"url": "https://www.theclm.org/Magazine/topic/extracontractual", "category": "Extra-Contractual"},
            {"url": "https://www.theclm.org/Magazine/topic/fraud", "category": "Fraud"},
            {"url": "https://www.theclm.org/Magazine/topic/litigation", "category": "Litigation Management"},
            {"url": "https://www.theclm.org/Magazine/topic/product", "category": "Product"},
            {"url": "https://www.theclm.org/Magazine/topic/property", "category": "Property"},
            {"url": "https://www.theclm.org/Magazine/topic/rrh", "category": "RRH"},
            {"url": "https://www.theclm.org/Magazine/topic/subrogation", "category": "Subrogation"},
            {"url": "https://www.theclm.org/Magazine/topic/transportation", "category": "Transportation"},
            {"url": "https://www.theclm.org/Magazine/topic/workerscomp", "category": "Workers' Compensation"},
        ],
        "listing": {
            "link_selector": "a.article-link[href*='/Magazine/articles/']",
            "edition_selector": "#archive_editions a[href*='Editions/']",
        },
        "extraction": {
            "dom_fallback": {
                "enabled": True,
                "selectors": {
                    "title": "h1.article-link",
                    "body": "div.col-12.card-text > div:nth-of-type(3)",
                    "author": "#accordionExample .col-10",
                    "date_text": "span.artdate",
                },
            },
            "images": {"container": "div.col-12.card-text", "base_url": "https://www.theclm.org"},
        },
        "url_filters": {
            "include": [r"^https://www\.theclm\.org/Magazine/articles/.+/[0-9]+$"],
            "exclude": [r"\?.*utm_"],
        },
        "hooks": {"archive_mark": "/Home/Archive", "category_rule": "listing", "publisher": "The CLM"},
    },
    "griffith": {
        "entry_points": [
            {"url": "https://www.griffithfoundation.org/news", "category": "News"},
            {"url": "https://www.griffithfoundation.org/programming", "category": "Programming"},
            {"url": "https://www.griffithfoundation.org/thought-leadership", "category": "Thought Leadership"},
        ],
        "listing": {"link_selector": "h2 a[href]"},
        "extraction": {
            "jsonld": {
                "enabled": True,
                "type_filter": "Article",
                "field_map": {
                    "title": "headline",
                    "author": "author",
                    "date_published": "datePublished",
                    "canonical_url": "url",
                },
            },
            "dom_fallback": {"enabled": True, "selectors": {"body": "article .sqs-block-content", "title": "h1"}},
            "images": {"container": "article .sqs-block-content", "base_url": "https://www.griffithfoundation.org"},
        },
        "url_filters": {
            "include": [r"^https://www\.griffithfoundation\.org/(news|programming|thought-leadership)/.+"],
            "exclude": [r"/\?author=", "/category/", r"\?.*utm_"],
        },
        "hooks": {"link_mode": "read_more_or_css", "dedup_scope": "page", "category_rule": "list_or_listing"},
    },
    "iasa": {
        "entry_points": [
            {
                "url": "https://www.iasa.org/IASA/IASA/Insights/Insight-Articles/Insights.aspx",
                "category": "Insurance Insights",
            },
            {"url": "https://www.iasa.org/IASA/IASA/Insights/News/News.aspx", "category": "IASA News"},
        ],
        "listing": {"link_selector": "#mainContentWrapper a[href*='.aspx']"},
        "extraction": {
            "dom_fallback": {
                "enabled": True,
                "selectors": {"body": "#mainContentWrapper", "title": "#mainContentWrapper h2"},
            },
            "images": {"container": "#mainContentWrapper", "base_url": "https://www.iasa.org"},
        },
        "url_filters": {
            "include": [r"^https://www\.iasa\.org/IASA/.*Insights/.+\.aspx$"],
            "exclude": [r"/Insights\.aspx$", r"/News\.aspx$", r"\?.*utm_"],
        },
        "hooks": {"dedup_scope": "page", "category_rule": "listing"},
    },
    "iaum": {
        "sitemap_url": "https://insuranceaum.com/sitemap.xml",
        "extraction": {
            "jsonld": {
                "enabled": True,
                "type_filter": "NewsArticle",
                "field_map": {
                    "title": "name",
                    "date_published": "datePublished",
                    "description": "description",
                    "canonical_url": "@id",
                    "categories": "about",
                },
            },
            "dom_fallback": {
                "enabled": True,
                "selectors": {
                    "body": "article .field--name-body, article .node__content, .node--type-article .field--name-body",
                    "title": "h1",
                    "author": ".field--name-field-author, .node__meta .field--name-uid",
                },
            },
            "images": {
                "container": "article .field--name-body, article .node__content",
                "base_url": "https://insuranceaum.com",
                "lazy_load": True,
            },
        },
        "url_filters": {
            "include": [r"^https://insuranceaum\.com/.+"],
            "exclude": [
                "/user/",
                "/admin/",
                "/search/",
                "/node/",
                "/category/",
                "/events",
                "/podcast-center",
                "/members",
                "/professional-learning",
                r"/sitemap\.xml",
                r"\?.*utm_",
            ],
        },
        "hooks": {"dedup_scope": "none", "category_rule": "first"},
    },
    "iis": {
        "entry_points": [
            {"url": "https://www.internationalinsurance.org/insights-research-1", "category": "Insights & Research"},
        ],
        "pagination": {"page_param": "page", "next_page_selector": "a.pagination__link.pagination__next"},
        "listing": {"link_selector": "a.topic-grid-block__item"},
        "extraction": {
            "dom_fallback": {
                "enabled": True,
                "selectors": {
                    "title": "h1.post-title",
                    "body": "div.field--name-body.field__item",
                    "author": "div.field--name-field-article-author .field__item",
                    "category": "div.field--name-field-topics .field__item a",
                    "date": 'span[property="schema:dateCreated"]',
                    "tags": "div.field--name-field-tags .field__item a",
                },
            },
            "images": {
                "container": "div.field--name-field-image, div.field--name-body",
                "base_url": "https://www.internationalinsurance.org",
                "lazy_load": True,
            },
        },
        "url_filters": {
            "include": [r"^https://www\.internationalinsurance\.org/.+"],
            "exclude": [
                "/user/",
                "/admin/",
                "/search/",
                "/node/",
                "/sitemap",
                r"\?.*utm_",
                "/global_priorities_survey",
                "/shin_research_library",
                "/leaders_of_tomorrow_research",
                "/executive_insights_library",
            ],
        },
        "hooks": {
            "date_attr": "content",
            "category_rule": "topics_and_tags",
            "publisher": "International Insurance Society",
        },
    },
    "itl": {
        "entry_points": [
            {
                "url": "https://www.insurancethoughtleadership.com/ai-machine-learning",
                "category": "AI & Machine Learning",
            },
            {
                "url": "https://www.insurancethoughtleadership.com/customer-experience",
                "category": "Customer Experience",
            },
            {
                "url": "https://www.insurancethoughtleadership.com/resilience-sustainability",
                "category": "Resilience & Sustainability",
            },
            {"url": "https://www.insurancethoughtleadership.com/cyber", "category": "Cyber"},
            {
                "url": "https://www.insurancethoughtleadership.com/future-of-the-industry",
                "category": "Future of the Industry",
            },
            {
                "url": "https://www.insurancethoughtleadership.com/new-business-models",
                "category": "New Business Models",
            },
            {"url": "https://www.insurancethoughtleadership.com/talent-culture", "category": "Talent & Culture"},
            {"url": "https://www.insurancethoughtleadership.com/type/big-picture", "category": "Big Picture"},
        ],
        "pagination": {"page_param": "page", "last_page_selector": "li.pager__item--last a"},
        "listing": {"link_selector": ".region-content h5 a[href]"},
        "extraction": {
            "jsonld": {
                "enabled": True,
                "type_filter": "Article",
                "field_map": {
                    "title": "headline",
                    "author": "author.name",
                    "date_published": "datePublished",
                    "description": "description",
                    "canonical_url": "url",
                    "publisher": "publisher.name",
                },
            },
            "dom_fallback": {
                "enabled": True,
                "selectors": {
                    "body": "div.article__body",
                    "title": "h1.page-title",
                    "date": "time[datetime]",
                    "category": "nav.breadcrumb ol li a",
                    "author": "div.field--name-field-author",
                },
            },
            "images": {
                "container": "div.article__body",
                "base_url": "https://www.insurancethoughtleadership.com",
            },
        },
        "url_filters": {
            "include": [r"^https://www\.insurancethoughtleadership\.com/.+"],
            "exclude": ["/user/", "/search/", "/admin/", r"\?.*utm_"],
        },
        "hooks": {"dedup_scope": "none", "category_rule": "merged_or_listing"},
    },
    "rih": {
        "entry_points": [
            {"url": "https://riskandinsurance.com/category/critical-risks/", "category": "Critical Risks"},
            {
                "url": "https://riskandinsurance.com/category/risksrm/risk-management-2/",
                "category": "Risk Management",
            },
            {
                "url": "https://riskandinsurance.com/category/industries/insurance-industry/",
                "category": "The Insurance Industry",
            },
            {"url": "https://riskandinsurance.com/category/general/claims/", "category": "Claims & The Law"},
            {"url": "https://riskandinsurance.com/category/workers-comp/", "category": "Workers' Comp Forum"},
            {
                "url": "https://riskandinsurance.com/category/conferences-parent/national-comp-conference/",
                "category": "National Comp",
            },
            {
                "url": "https://riskandinsurance.com/category/site-functionality-parent/risk-insider/",
                "category": "Risk Insiders",
            },
            {"url": "https://riskandinsurance.com/category/sector-focus-parent/", "category": "Sector Focus"},
            {"url": "https://riskandinsurance.com/category/risk-matrix/", "category": "Risk Matrix"},
        ],
        "pagination": {"next_page_selector": "a.next.page-numbers"},
        "extraction": {
            "jsonld": {
                "enabled": True,
                "type_filter": "WebPage",
                "field_map": {"date_published": "datePublished", "canonical_url": "url"},
            },
            "dom_fallback": {
                "enabled": True,
                "selectors": {
                    "title": "article.format-main-article h1",
                    "body": "article.format-main-article div.contents",
                    "author": "article.format-main-article div.author a.author",
                    "category": "article.format-main-article div.categories a",
                },
            },
            "images": {
                "container": "article.format-main-article div.contents",
                "base_url": "https://riskandinsurance.com",
            },
        },
        "url_filters": {
            "include": [r"^https://riskandinsurance\.com/[^/]+/$"],
            "exclude": [
                "/category/",
                "/author/",
                "/tag/",
                "/page/",
                "/wp-content/",
                "/wp-admin/",
                "/wp-json/",
                "/feed/",
                "/articles-index/",
                "/about-us/",
                "/contact",
                "/sitemap",
                r"\?.*utm_",
            ],
        },
        "hooks": {"link_mode": "headline", "category_rule": "first_or_listing", "publisher": "Risk & Insurance"},
    },
    "ti": {
        "sitemap_url": "https://web.theinstitutes.org/sitemap.xml",
        "extraction": {
            "jsonld": {
                "enabled": True,
                "type_filter": "EducationalOccupationalProgram",
                "field_map": {"title": "name", "description": "description", "canonical_url": "url"},
            },
            "dom_fallback": {
                "enabled": True,
                "selectors": {"title": "h1.hero__title", "body": "div#block-ti-west-content"},
            },
            "images": {"container": "div#block-ti-west-content", "base_url": "https://web.theinstitutes.org"},
        },
        "url_filters": {
            "include": [
                r"^https://web\.theinstitutes\.org/designations/.+",
                r"^https://web\.theinstitutes\.org/ceu/.+",
                r"^https://web\.theinstitutes\.org/agents-and-brokers/.+",
            ],
            "exclude": ["/user/", "/admin/", "/search/", "/node/", r"\?.*utm_"],
        },
        "hooks": {
            "dedup_scope": "none",
            "category_rule": "prefix",
            "publisher": "The Institutes",
            "prefix_categories": {
                "/designations/": "Designations",
                "/ceu/": "CEU",
                "/agents-and-brokers/": "Agents & Brokers",
            },
        },
    },
}
