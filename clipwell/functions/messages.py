"""Explanation texts of the rule models. Reports show them literally."""

# Account recommendations.
ACCOUNT = {
    "activity_reason": "视频产出和可见数据量偏弱",
    "activity_action": "优先保持稳定发布频率，补齐连续视频样本",
    "activity_keep": "保持当前发布节奏，继续做同主题连续输出",
    "execution_reason": "视频详情可提取程度还不够稳定",
    "execution_action": "优先保证视频标题、时长、发布时间等基础字段可稳定获取",
    "interaction_reason": "评论侧可观测信号还不够强",
    "interaction_action": "增加评论引导、提问式结尾和可互动话题",
    "stability_reason": "采集或页面结构波动较多",
    "stability_action": "先处理 warnings，减少 incomplete 和 placeholder 路径",
    "balanced_reason": "该账号当前四项分数整体均衡，适合作为同类账号的参考样本",
    "balanced_action": "继续维持当前结构，并优先沉淀高分视频的共性",
    "separator": "；",
    "empty_title": "先补足可评分账号",
    "empty_reason": "当前没有可用的账号评分结果，先确保 summary_block.account_summary 非空。",
    "empty_action_1": "确认 batch summary_block 已正确生成",
    "empty_action_2": "检查 full-batch 采集是否返回 account_summary",
}

# Post fit.
FIT_STRENGTHS = {
    "views_1000": "样本量较充足，适合用来判断内容真实表现。",
    "views_100": "当前观看量足以做初步规则判断。",
    "views_few": "尽管样本量偏小，但仍可作为早期方向观察。",
    "likes": "点赞率较高，说明开头或整体内容吸引力不错。",
    "comments": "评论率较高，说明内容具备讨论或提问空间。",
    "shares": "转发率较高，说明内容有传播或收藏分享价值。",
    "account": "账号侧基础分较高，视频与账号整体风格更容易协同放大。",
}
FIT_RISKS = {
    "views": "观看量过小，当前结论更偏早期信号，稳定性有限。",
    "likes": "点赞率偏低，说明视频吸引力或封面/开头可能不足。",
    "comments": "评论率偏低，内容互动引导可能不够强。",
    "shares": "转发率偏低，内容的传播点或外显价值不足。",
    "account": "账号侧基线较弱，单条视频的适配判断需要更谨慎。",
    "none": "暂未发现明显风险点。",
}
FIT_ACTIONS = {
    "high_1": "优先复制当前视频的选题、开头结构和节奏，形成同模板批量测试。",
    "high_2": "保留现有账号风格，并围绕高表现点扩展相邻题材。",
    "medium_1": "保留当前题材，但优先微调开头钩子、标题和评论引导。",
    "medium_2": "继续采样同类视频，确认是否是稳定适配而非偶然波动。",
    "low_1": "先不要放大当前模板，优先调整选题、开头和前3秒信息密度。",
    "low_2": "用 3 到 5 条对照视频验证哪些元素能抬升互动率。",
    "comments": "在结尾加入明确提问或二选一问题，提升评论触发率。",
    "shares": "补充更强的实用性、总结性或情绪共鸣点，提升传播性。",
    "likes": "强化标题、封面和首屏节奏，缩短价值到达时间。",
    "sample": "把这条视频归为正样本，后续可用于模板沉淀。",
    "keep": "保留当前高分特征，优先观察是否在更多样本中稳定复现。",
}

# Local visual fit.
VISUAL_GOOD = {
    "portrait": "竖屏形态符合抖音主流内容消费习惯。",
    "duration": "时长处于中短视频较常见的可接受区间。",
    "resolution": "画面分辨率较高，利于塑造专业感。",
    "balanced": "整体亮度较均衡，适合知识/讲解型内容观看。",
    "bright": "画面整体较亮，首屏可视性较好。",
    "contrast": "画面对比度较强，有利于突出主体与文字信息。",
    "saturation_medium": "色彩饱和度适中，画面观感相对自然。",
    "saturation_high": "色彩相对鲜明，可能提升首屏吸引力。",
    "bitrate": "码率较高，细节保留更充分。",
    "subtitle": "字幕区域可读性较好，适合讲解型内容承接信息。",
    "talking_head": "画面节奏较稳定，适合讲解型/口播型内容承载。",
    "clean": "整体画面风格干净，较适合知识表达场景。",
    "dynamic": "画面节奏更活跃，可能更利于首屏吸引。",
    "none": "当前视频暂无明显画面侧强信号。",
}
VISUAL_RISKS = {
    "not_portrait": "非竖屏内容在抖音原生分发环境中通常更吃亏。",
    "too_short": "视频时长过短，不利于承载完整讲解或转化结构。",
    "too_long": "视频时长偏长，需要更强节奏控制才能维持完播。",
    "resolution": "分辨率偏低，会削弱账号内容质感。",
    "dark": "画面偏暗，容易影响信息识别和停留。",
    "contrast": "画面对比度偏低，主体可能不够突出。",
    "saturation": "色彩饱和度偏低，视觉记忆点可能不够强。",
    "bitrate": "码率偏低，复杂画面时可能影响清晰度。",
    "subtitle": "字幕区域可读性偏弱，可能影响知识点传达和停留。",
    "exposure": "存在低曝光风险，可能削弱人物、字幕或板书可读性。",
    "none": "当前视频在基础画面侧未发现明显短板。",
}
VISUAL_ACTIONS = {
    "high": "保留当前拍摄构图与清晰度配置，优先复用到同类选题。",
    "medium": "保持当前视频结构，但优先微调画面表达与前10秒节奏。",
    "low": "先不要放大当前模板，优先修画面表达和基础包装。",
    "not_portrait": "改成 9:16 竖屏构图，减少平台原生分发损耗。",
    "dark": "提高主光或整体曝光，让人物和字幕更容易识别。",
    "contrast": "增强主体与背景分离，提升人物或板书的识别度。",
    "saturation": "适当增加色彩层次或封面冲击力，提升首屏吸引力。",
    "over_50": "压缩铺垫段落，把核心价值前置到前15秒。",
    "under_12": "补足完整讲解链路，避免信息量不足导致转化弱。",
    "talking_head": "可以强化老师/人物主体与字幕协同，往稳定讲解型模板沉淀。",
    "dynamic": "保留动态切换优势，同时注意不要牺牲知识点清晰度。",
    "subtitle_low": "提升底部字幕区域明暗对比，避免字幕被背景吞没。",
    "subtitle_high": "保留当前字幕可读性配置，后续适合接 OCR/字幕分析链路。",
}

# Fusion, per component (strength, risk, action, missing risk, missing action).
FUSION = {
    "local_visual": (None, None, None, "缺少本地画面基础分析结果。", "先运行本地视频输入与基础画面分析。"),
    "face_quality": (
        "人物出镜清晰且表情状态较好。", "未检测到稳定人脸，口播账号适配风险较高。", "优先保证人物脸部清晰、居中、少遮挡。",
        "缺少人脸/出镜质量特征。", "补充人脸检测、居中度、清晰度和表情积极度特征。",
    ),
    "pose_quality": (
        "姿态对讲解表达有支撑。", "人物姿态对镜头表达支撑不足。", "保持正向镜头与稳定上半身构图。",
        "缺少姿态识别特征。", "补充正脸朝向、上半身可见、手势活跃度和稳定度特征。",
    ),
    "person_subject": (
        "人物主体明确，适合IP型讲解。", "人物主体不唯一或不稳定，容易削弱账号记忆点。", "保证单一主体突出，减少背景干扰。",
        "缺少人物主体检测特征。", "补充人物框占比、居中度、人数和背景杂乱度。",
    ),
    "ocr_subtitle": (
        "字幕信息对知识表达有帮助。", "字幕承接信息不足，可能影响静音观看和知识点理解。", "提高字幕可读性，保留核心知识词。",
        "缺少OCR字幕特征。", "补充字幕文本、覆盖率、可读性和关键词密度。",
    ),
    "asr_speech": (
        "语音节奏与开场吸引力较好。", "语音节奏或开场吸引力偏弱。", "优化前3秒钩子，并控制语速与停顿。",
        "缺少ASR语音转文字特征。", "补充转写文本、语速、停顿比例和开场钩子。",
    ),
    "script_structure": (
        "口播结构完整，适合复盘与迁移。", "话术结构缺项：", "按钩子-痛点-方法-例子-行动的顺序补齐话术。",
        "缺少口播话术结构特征。", "补充钩子、痛点、方法、例子、转化动作等结构标签。",
    ),
}
LIST_COMMA = "、"

# Effect score.
EFFECT_RISKS = {
    "structure": "口播结构不完整，缺少钩子、方法、例子或行动召唤。",
    "subtitle": "字幕一致性偏弱，静音观看理解成本较高。",
    "subject": "人物主体不稳定，可能削弱老师 IP 记忆点。",
    "no_text": "缺少拟发布标题/文案/口播文本，评论潜力只能按结构弱估。",
    "no_topic": "未识别到明确评论钩子，上架前建议补充问题或资料入口。",
}
EFFECT_ACTIONS = {
    "no_topic": "结尾增加低门槛评论问题，例如年级报数、A/B 选择、是否需要资料。",
    "structure": "按“结论钩子-痛点-方法-例子-评论问题”重写脚本。",
    "subject": "减少多人和复杂背景，保证单一老师或单一视觉焦点。",
    "demand": "把标题和结尾导向资料领取、报考咨询或家长问题，提高评论转化潜力。",
    "steady": "当前上架前模型表现较稳，优先测试标题钩子和封面首屏。",
}
EFFECT_TIP = "复用高分视频结构，继续测试标题和评论钩子"

# Account tips by mean thresholds (three reports).
TIPS_MULTIMODAL = {
    "structure": "强化口播结构：开头钩子、痛点、方法、例子、结尾提问要更完整。",
    "subtitle": "统一字幕风格：关键词位置、字体层级和节奏保持一致。",
    "subject": "降低多主体干扰：知识讲解尽量突出单一老师或单一视觉焦点。",
    "face": "优化人物居中和脸部清晰度，增强账号记忆点。",
    "speed": "适当降低语速并增加停顿，方便学生和家长跟上知识点。",
    "none": "基础画面质量较稳，优先迭代选题、标题和评论互动钩子。",
}
TIPS_SHORT = {
    "structure": "补齐钩子-痛点-方法-例子-行动的话术结构",
    "subtitle": "统一字幕样式和关键词位置",
    "subject": "减少多人/复杂背景，突出单一视觉焦点",
    "face": "提高人物居中和脸部清晰度",
    "none": "优先优化选题、标题和评论钩子",
}
TIPS_COMMENTS = {
    "material": "把资料领取入口固定到评论置顶/私信关键词，减少用户流失",
    "exam": "围绕报考门槛、备考路径、年级适配做系列内容",
    "doubt": "用真题对比、难度标尺和适用人群回应质疑",
    "reply": "提高作者回复率，把咨询评论转成二次选题",
    "structure": "口播结构补齐钩子-方法-例子-行动",
    "none": "评论样本较少，优先扩大评论采集覆盖再细分策略",
}
TIPS_TITLES = {
    "has_grade": "标题和开头更明确年级/阶段，降低用户判断成本",
    "has_method": "增加口诀、方法、避坑、规划类表达，强化可收藏价值",
    "has_material": "补充资料/练习/清单类钩子，引导保存和评论索取",
    "has_parent_child": "把痛点从知识点转成家长/孩子场景，提升共鸣",
    "has_interaction": "在标题或结尾加入明确提问，提升评论触发",
    "none": "保持高表现视频的选题密度，优先复刻账号内 Top 视频结构",
}
