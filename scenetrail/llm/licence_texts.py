"""Licence notices by family, and sentences that use the same words without licensing anything."""

TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license.",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Distributed under the GNU GPL v2 or later.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc0": (
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This is free and unencumbered software released into the public domain.",
    ),
}

OTHER = (
    "He lost his driver's license and had to apply for a new one.",
    "The new version 2.0 of the software was released last week.",
    "The restaurant is licensed to sell wine and beer.",
    "Permission to enter the building is granted by the office.",
    "A general election will be held for the public office.",
    "The public library is free for all residents.",
    "This work is the result of ten years of research.",
    "The terms of the agreement were published in the paper.",
    "You may obtain a copy of the report from the office.",
    "Copyright 2019 by the author. All rights reserved.",
    "The Apache helicopter is used by the army.",
    "Apache Spark and Apache Kafka are distributed systems.",
    "He studied at MIT before he moved to Boston.",
    "The MIT professor published a paper on public policy.",
    "The GNU project was announced in 1983.",
    "The general public is invited to the opening.",
    "The city issues a license for each dog.",
    "The software foundation published its annual report.",
    "Creative people are not common in this work.",
    "The international license for drivers is valid for one year.",
    "The creative director left the company after a year.",
    "This file is used by the program to store its source code.",
    "The source code can be found in the file.",
    "Redistribution of income was the subject of the debate.",
    "Binary forms of the message were sent by radio.",
    "The following conditions are met by the new design.",
    "Version 3 of the draft is available at the office.",
    "Any later version of the plan will be published here.",
    "The rights to use the land were sold without restriction.",
    "Free of charge, to any person who asks.",
    "The author has waived the fee.",
    "The lake is in the public domain.",
    "BSD was developed at Berkeley.",
    "Mozilla released a new version of the browser.",
    "The attribution of the painting is a subject of debate.",
    "Licensed plumbers are hard to find.",
    "Software is eating the world.",
    "Terms and conditions apply.",
    "The library is open, and the software is free to use at any time.",
    "See the license.",
)
